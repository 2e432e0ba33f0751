"""URL filters by cascades of Bloom filters.

A rule is a host and the beginning of a path. The keys of a URL are all pairs of
a suffix of its host and a beginning of its path of a length that some rule has.
A cascade answers exactly whether a key of the corpus is listed: level 0 encodes
the listed keys, level 1 those unlisted keys of the corpus that pass level 0 by
chance, level 2 the listed keys that pass level 1, and so on until no key passes
wrongly. A key is listed if the number of levels that it passes in a row is odd.
One cascade holds the keys to allow, one those to block. No join takes part: the
levels are bit tables that every task reads.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lexloom.llm.common import given_back, others, table

#: (host, path, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
PROBES = 4
#: Rules whose cascades are sent to every task at once (some 2 bytes each); more rules take more passes over the rows.
PART_RULES = 8_000_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Return the host (A-Z lower-cased) and the path of ``url``; both are empty without a ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column, lengths: Iterable[int]) -> Column:
    """Return the array of a URL's keys, the longest first (of equally long ones that of the longer host)."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in sorted(set(lengths))]), lambda n: n <= F.length(path))

    def with_path(s: Column) -> Column:
        return F.transform(fitting, lambda n: F.struct((F.length(s) + n).alias("long"), F.length(s).alias("host"), F.concat(s, F.substring(path, F.lit(1), n)).alias("key")))

    return F.transform(F.sort_array(F.flatten(F.transform(suffixes, with_path)), asc=False), lambda k: k["key"])


def hashes(keys: Sequence[str]) -> np.ndarray:
    """Return the 128-bit hash of each key, as two columns of 64 bits."""
    raw = b"".join(xxhash.xxh3_128_digest((k or "").encode("utf-8", "surrogatepass")) for k in keys)
    return np.frombuffer(raw, "<u8").reshape(-1, 2)


@dataclass
class Bloom:
    """One level: a packed bit table, and a salt that makes the levels independent."""

    bits: np.ndarray
    slots: int
    salt: int

    @classmethod
    def of(cls, keys: np.ndarray, salt: int, per_key: float) -> Bloom:
        slots = max(64, int(len(keys) * per_key) + 1)
        level = cls(np.zeros(slots // 8 + 1, np.uint8), slots, salt)
        for slot in level.probes(keys):
            np.bitwise_or.at(level.bits, slot >> 3, (1 << (slot & 7)).astype(np.uint8))
        return level

    def probes(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        with np.errstate(over="ignore"):
            step = (keys[:, 1] ^ np.uint64(self.salt)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
            for k in range(PROBES):
                mixed = (keys[:, 0] + np.uint64(k + 1) * step) * np.uint64(0xBF58476D1CE4E5B9)
                yield ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(self.slots)).astype(np.int64)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        ok = np.ones(len(keys), bool)
        for slot in self.probes(keys):
            ok &= (self.bits[slot >> 3] >> (slot & 7)) & 1 == 1
        return ok


def holds(levels: list[Bloom], keys: np.ndarray) -> np.ndarray:
    """Return which keys are listed: those that pass an odd number of levels in a row."""
    depth, alive = np.zeros(len(keys), np.int64), np.arange(len(keys))
    for level in levels:
        alive = alive[level.passes(keys[alive])]
        depth[alive] += 1
    return depth % 2 == 1


def deepen(first: Bloom, listed: np.ndarray, strays: np.ndarray, per_key: float) -> list[Bloom]:
    """Return a cascade's levels: ``first``, then alternately the strays and the listed keys that still pass."""
    levels = [first]
    wrong, right = strays, listed
    while len(wrong):
        if len(levels) > 60:
            raise ValueError("two keys share all hashes")
        levels.append(Bloom.of(wrong, len(levels), per_key))
        wrong, right = right[levels[-1].passes(right)], wrong
    return levels


def is_in(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Return which keys are among ``ordered`` (sorted by the first column)."""
    if not len(ordered):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(ordered[:, 0], keys[:, 0]), len(ordered) - 1)
    return (ordered[at] == keys).all(1)


def cascades(keys: DataFrame, lists: list[list[str]], per_key: float = 12.0) -> list[list[Bloom]]:
    """Return one cascade for each of ``lists``, exact for all keys in the array column of ``keys``.

    Level 0 gets so many bits that about as many keys of the corpus pass by
    chance as are listed; these strays, and nothing else, come to the driver. If
    there are many times more of them, which chance rules out, an error is raised.
    """
    listed = [h[np.lexsort((h[:, 1], h[:, 0]))] for h in (hashes(sorted(set(x))) for x in lists)]
    total = keys.agg(F.coalesce(F.sum(F.size("_keys")), F.lit(0))).first()[0]
    firsts = []
    for h in listed:
        aim = min(0.02, max(len(h), 8) / max(total, 1))  # of the other keys, the share that may pass
        firsts.append(Bloom.of(h, 0, max(per_key, -PROBES / np.log1p(-(aim ** (1 / PROBES))))))
    shared = keys.sparkSession.sparkContext.broadcast((firsts, listed))  # bounded by PART_RULES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, known = shared.value
        for batch in batches:
            got = hashes(np.unique(np.array(batch.column(0).flatten().to_pylist(), object)).tolist())
            for k, (level, own) in enumerate(zip(levels, known, strict=True)):
                stray = got[level.passes(got) & ~is_in(got, own)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(stray), pa.int32()), pa.array(stray[:, 0]), pa.array(stray[:, 1])], ["k", "a", "b"])

    strays = keys.select("_keys").mapInArrow(run, "k int, a long, b long").distinct()
    most = 100_000 + 20 * sum(map(len, listed))
    found = strays.limit(most).collect()
    if len(found) == most:
        raise ValueError("too many keys pass the first level")
    out = []
    for k, (first, own) in enumerate(zip(firsts, listed, strict=True)):
        mine = np.array([(r["a"], r["b"]) for r in found if r["k"] == k], np.int64).reshape(-1, 2).view(np.uint64)
        out.append(deepen(first, own, mine, per_key))
    return out


def url_filter(pages: DataFrame, rules: DataFrame, url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """Return ``pages`` with _host, _path, _rule (the longest that fits, else null) and _verdict.

    ``rules`` has host, path and verdict (allow or block; null parts are empty).
    A rule fits its host and all subdomains where the URL's path starts with the
    rule's. If a rule is given with both verdicts, it blocks. A null URL, one
    without ``://`` and any that no rule fits get ``otherwise``. An empty table
    gives no rows; without rules every row gets ``otherwise``. Columns of
    ``pages`` that have the names of the results are replaced; all others stay.
    """
    made = ("_host", "_path", "_rule", "_verdict")
    row, names = others(pages, made)
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(row, host.alias("_host"), path.alias("_path"))
    rules = rules.select(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    parts = max(1, -(-rules.count() // PART_RULES))
    named = F.concat("host", "path")
    rows = rows.withColumns({"_keys": keys_of(F.col("_host"), F.col("_path"), lengths) if lengths else F.array().cast("array<string>"), "_at": F.lit(None).cast("int"), "_found": F.lit(None).cast("string")})
    for part in range(parts):
        listed: dict[str, str] = {}
        for r in rules.where(F.pmod(F.xxhash64(named), F.lit(parts)) == part).select(named.alias("key"), "verdict").collect():  # at most about PART_RULES
            listed[r["key"]] = "block" if "block" in (r["verdict"], listed.get(r["key"])) else "allow"
        rows = judged(rows, cascades(rows.select("_keys"), [[k for k, v in listed.items() if v == verdict] for verdict in ("allow", "block")]))
    rule = F.when(F.col("_at").isNotNull(), F.get("_keys", F.col("_at")))
    rows = rows.withColumns({"_rule": rule, "_verdict": F.coalesce("_found", F.lit(otherwise))})
    return rows.select(*given_back(names), *made)


def judged(rows: DataFrame, lists: list[list[Bloom]]) -> DataFrame:
    """Return ``rows`` with _at and _found set to the first listed key and its verdict, where that comes before what is there."""
    shared = rows.sparkSession.sparkContext.broadcast(lists)
    names = rows.columns
    slots = [names.index(c) for c in ("_keys", "_at", "_found")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at, found = (batch.column(k) for k in slots)
            count = np.asarray(keys.value_lengths().fill_null(0))
            owner = np.repeat(np.arange(len(count)), count)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            got = hashes(keys.flatten().to_pylist())
            best = np.array([1 << 30 if x is None else x for x in at.to_pylist()], np.int64)
            verdict = np.array(found.to_pylist(), object)
            for name, levels in zip(("allow", "block"), shared.value, strict=True):
                hit = np.flatnonzero(holds(levels, got))
                first = np.full(len(count), 1 << 30)
                np.minimum.at(first, owner[hit], place[hit])
                verdict = np.where(first < best, name, verdict)
                best = np.minimum(best, first)
            columns = list(batch.columns)
            columns[slots[1]] = pa.array([None if x == 1 << 30 else x for x in best.tolist()], pa.int32())
            columns[slots[2]] = pa.array(verdict.tolist(), pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = {"_at": StructField("_at", IntegerType()), "_found": StructField("_found", StringType())}
    return rows.mapInArrow(run, StructType([fields.get(f.name, f) for f in rows.schema.fields]))


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    found = url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return found.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


OP2_SQL = r"""
WITH split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fitting AS (
  SELECT p.*, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id, p.host, p.path ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS nth
  FROM parts p LEFT JOIN rules ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE nth = 1
"""
