"""Named queries over the count tables and the driver registry."""
