"""URL rules in a sorted digest array (operator 4).

The rules' strings (host and path) are hashed to 64 bits with xxhash, sorted,
and written with their strings and verdicts to one file.  Spark ships the file
to every executor, where tasks memory-map it.  A url's candidates are every
suffix of its host at a dot, each with every length of path that some rule has;
a batch's candidates are probed with one vectorised binary search, and a found
key counts only if the stored string is the candidate's, whatever the hash.

The file goes out whole, so its size is checked: beyond ``MAX_ARRAY_BYTES`` the
same candidates join the rules in Spark instead.

Defined results: null url, or one without ``://``: empty host and path, no
rule, the default verdict; of two equal rules the first counts; the longest rule is
that of most UTF-8 bytes; hosts of any length are judged by their ends alone, no
longer than a rule's host; null and repeated ids: a row for each row; an empty
table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import common as C
from editpulse.session import checkpoint_root
from editpulse.sinks.versioned import _fs as hadoop_path

#: The digest array is shipped up to this size.
MAX_ARRAY_BYTES = 256 << 20
DEFAULT_VERDICT = "allow"
#: Host and path of each rule, and its verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def digest_array(rules) -> bytes:
    """The digest array of ``(host, path, verdict)`` rules.

    Layout, all 64-bit: number of rules, of path lengths, the path lengths, the
    sorted keys, the strings' offsets (one more), then verdicts and strings."""
    first = {}
    for host, prefix, verdict in rules:
        first.setdefault((host.encode() + prefix.encode()), (verdict, len(prefix.encode())))
    strings = sorted(first, key=lambda s: (xxhash.xxh64_intdigest(s), s))
    keys = np.array([xxhash.xxh64_intdigest(s) for s in strings], np.uint64)
    offsets = np.cumsum([0, *map(len, strings)]).astype(np.int64)
    paths = np.array(sorted({n for _, n in first.values()}), np.int64)
    verdicts = np.array([[first[s][0] == "allow", first[s][1]] for s in strings], np.int64).reshape(-1)
    parts = (np.array([len(strings), len(paths)], np.int64), paths, keys, offsets, verdicts)
    return b"".join([*(p.tobytes() for p in parts), *strings])


class DigestArray:
    """A memory-mapped digest array."""

    def __init__(self, path: str):
        whole = np.memmap(path, np.uint8, "r")
        n, m = (int(x) for x in whole[:16].view(np.int64))
        edges = np.cumsum([16, 8 * m, 8 * n, 8 * (n + 1), 16 * n])
        part = [whole[a:b] for a, b in zip(edges[:-1], edges[1:])]
        self.paths, self.keys, self.offsets = part[0].view(np.int64), part[1].view(np.uint64), part[2].view(np.int64)
        self.verdicts, self.strings = part[3].view(np.int64).reshape(n, 2), whole[edges[-1]:]
        self.longest = int((np.diff(self.offsets) - self.verdicts[:, 1]).max()) if n else -1

    def probe(self, candidates: list[bytes]) -> np.ndarray:
        """Number of each candidate's rule, or -1."""
        keys = np.fromiter(map(xxhash.xxh64_intdigest, candidates), np.uint64, len(candidates))
        at = np.searchsorted(self.keys, keys)
        out = np.full(len(keys), -1, np.int64)
        for i in np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == keys) if len(self.keys) else []):
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == keys[i]:  # equal digests: the stored strings decide
                if self.strings[self.offsets[k]:self.offsets[k + 1]].tobytes() == candidates[i]:
                    out[i] = k
                    break
                k += 1
        return out


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, host, path``: the host with A-Z lower-cased."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    rest = F.coalesce(F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END"), F.lit(""))
    rows = rows.select("page_id", rest.alias("rest"))
    host = F.regexp_extract("rest", r"^([^/?#]*)", 1)
    path = F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1)
    return rows.select("page_id", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"), path.alias("path"))


def candidates(host: bytes, path: bytes, lengths, longest: int | None = None) -> list[tuple[bytes, int]]:
    """Every suffix of the host at a dot with each possible length of path; and the path's length.
    A suffix longer than the ``longest`` host of a rule fits none and is left out."""
    out, at = [], 0
    if longest is not None and len(host) > longest:
        at = host.find(b".", len(host) - longest - 1) + 1
        if not at:
            return out
    while True:
        out += [(host[at:] + path[:n], n) for n in lengths if n <= len(path)]
        at = host.find(b".", at) + 1
        if not at:
            return out


def _judge(name: str):
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])

    def judge(batches):
        array = DigestArray(SparkFiles.get(name))
        lengths = array.paths.tolist()
        for batch in batches:
            hosts, paths = (batch[c].cast(pa.binary()).to_pylist() for c in ("host", "path"))
            probes, owner, prefix = [], [], []
            for i, (host, path) in enumerate(zip(hosts, paths)):
                for c, n in candidates(host, path, lengths, array.longest):
                    probes.append(c)
                    owner.append(i)
                    prefix.append(n)
            rule, verdict, size = [None] * len(batch), [DEFAULT_VERDICT] * len(batch), [-1] * len(batch)
            found = array.probe(probes)
            for j in np.flatnonzero(found >= 0):
                k, i = int(found[j]), owner[j]
                if array.verdicts[k, 1] == prefix[j] and len(probes[j]) > size[i]:  # host and path meet where the rule's do
                    size[i], rule[i] = len(probes[j]), probes[j].decode()
                    verdict[i] = "allow" if array.verdicts[k, 0] else "block"
            yield C.table(schema, batch["page_id"], batch["host"], batch["path"], rule, verdict)

    return judge


def judge_urls(pages: DataFrame, rules=RULES, max_bytes: int = MAX_ARRAY_BYTES) -> DataFrame:
    """Per page ``page_id, host, path, rule, verdict``: the longest rule that fits, and its verdict."""
    spark, rows, array = pages.sparkSession, parsed(pages), digest_array(rules)
    if len(array) > max_bytes:
        return _joined(rows, rules)
    name = f"rules-{uuid.uuid4().hex}.bin"
    path = f"{checkpoint_root(spark)}/{name}"
    fs, target = hadoop_path(spark, path)
    out = fs.create(target)
    out.write(bytearray(array))
    out.close()
    spark.sparkContext.addFile(path)
    return rows.mapInArrow(_judge(name), "page_id bigint, host string, path string, rule string, verdict string")


def _joined(rows: DataFrame, rules) -> DataFrame:
    """The same verdicts by an equi-join of candidates and rules, for arrays too large to ship."""
    spark = rows.sparkSession
    first = {}
    for host, prefix, verdict in rules:
        first.setdefault((host, prefix), verdict)
    table = spark.createDataFrame([(h, p, v, h + p) for (h, p), v in first.items()], "rule_host string, rule_path string, rule_verdict string, rule string")
    lengths = F.array(*[F.lit(n) for n in sorted({len(p) for _, p, *_ in rules})])
    labels = F.split("host", r"\.")
    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    most = max((h.count(".") + 1 for h, *_ in rules), default=1)  # labels of a rule's host
    first = F.greatest(F.lit(1), F.size("labels") - (most - 1))
    hosts = keyed.withColumn("labels", labels).withColumn("k", F.explode(F.sequence(first, F.size("labels")))).withColumn(
        "rule_host", F.array_join(F.slice("labels", F.col("k"), F.size("labels")), "."))
    tried = hosts.withColumn("n", F.explode(lengths)).where(F.char_length("path") >= F.col("n")).select(
        "row", "rule_host", F.expr("substring(path, 1, n)").alias("rule_path"))
    best = tried.join(table, ["rule_host", "rule_path"]).groupBy("row").agg(F.max_by(F.struct("rule", "rule_verdict"), F.octet_length("rule")).alias("b"))
    return keyed.join(best, "row", "left").select("page_id", "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.rule_verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"))


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(C.read(spark, sf_dir, "pages"))
