"""Write PLANS.md: the physical plan of every registered query, condensed.

    python tools/plans.py [sf_dir]   (default /root/testdata/sf0.01)

For each query: its operators in plan order, with the scan's pushed and
partition filters and read schema, and the partitioning of each exchange.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = ("PushedFilters", "PartitionFilters", "ReadSchema")


def condense(formatted: str) -> list[str]:
    out = []
    tree, _, details = formatted.partition("\n\n\n")
    for line in tree.splitlines():
        line = line.rstrip()
        if line and not line.startswith("=="):
            out.append(line)
    for block in details.split("\n\n"):
        head = block.strip().splitlines()[0] if block.strip() else ""
        for line in block.splitlines():
            if line.startswith(KEEP):
                out.append(f"    {head}: {line}")
            elif line.startswith("Arguments:") and re.search(r"Exchange|WindowGroupLimit|TakeOrdered", head):
                out.append(f"    {head}: {line[len('Arguments: '):][:160]}")
    return out


def stream_plan(spark, sf_dir: str) -> list[str]:
    """Executed plan of the last micro-batch of a short run of the job."""
    from editpulse.config import JobOptions, WindowSpec
    from editpulse.functions.parse import to_wire_json
    from editpulse.session import scratch_dir
    from editpulse.sources.testdata import edit_events
    from editpulse.streaming.job import read_lines_stream, run_to_end, start_counts_job

    root = scratch_dir(spark, "plans-stream")
    to_wire_json(edit_events(spark, sf_dir)).write.text(f"{root}/landing/c0")
    opts = JobOptions(window=WindowSpec("1 hour"), trigger=None, namespaces=(0,), idle_batches=False)
    q = run_to_end(start_counts_job(read_lines_stream(spark, f"{root}/landing/*"), opts,
                                    f"{root}/table", f"{root}/checkpoint"))
    text = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    return [re.sub(r"\[.*", "", line).rstrip() for line in text.splitlines() if line.strip()]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from editpulse.session import local_session
    from editpulse.plans import registry

    spark = local_session()
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `python tools/plans.py {sf_dir}` (Spark {spark.version}, AQE initial plans).",
        "Stream queries are omitted: they run a job and return a batch read of its sink.",
        "",
    ]
    for name, q in sorted(registry.queries().items()):
        if name.startswith("stream_"):
            continue
        df = q(spark, sf_dir)
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        lines += [f"## {name}", "", "```"] + condense(text) + ["```", ""]
    lines += ["## streaming job, one micro-batch", "",
              "The update-mode job over the events as JSON lines, namespace 0, 1-hour windows.",
              "Operators only; the leaf stands for the micro-batch's input files.", "", "```"]
    lines += stream_plan(spark, sf_dir) + ["```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
