"""Removal of long repeated byte strings with a run-length (r-) index.

A string of ``length`` bytes that starts in two places is found in three steps.

1. Anchors, in one pass over the texts. In every window of ``length`` bytes the
   leftmost smallest hash of its 64-byte substrings is chosen, so equal windows
   choose the same anchor at the same place. Each window start belongs to one
   anchor; an anchor's *stretch* is the text of the windows that chose it. Only
   stretches whose anchor occurs more than once can hold a repeated string, and of
   these only such that share a long core (the bytes that neighbouring windows
   have in common) with another.
2. Index. The distinct stretches of an anchor meet in one shard. There the
   suffix array of all of them gives the Burrows-Wheeler transform, of which the
   runs are kept, as letters and lengths, with the suffixes at their ends. The
   transform is used through these sampled run ends: by its properties a common
   prefix with the neighbouring suffix has to be measured at the ends of runs
   only; inside a run it falls by one from each text position to the next, so
   that one pass along the text streams the matching statistics of every position.
   The anchor says where to look, so no backward search (LF step) is needed.
3. Marks. Matches of ``length`` or more are mapped back to all documents that
   hold the stretch and joined to maximal spans.

What is known to repeat without a search is not indexed twice: a stretch that
occurs more than once (by two 64-bit hashes, the anchor's and its own) is marked
as a whole, and is in the index once, for the others to be compared with.

Where an anchor's stretches are too many bytes for one index, they are cut into
those of a window group, STEPS[0] neighbouring window starts each, and grouped by
the core of these; what is still too large is cut more finely, down to single
windows, of which equal ones are one. So no index is larger than CROWD_BYTES and
nothing is left out.

Very long texts are read in segments of SEGMENT window starts. In a run of a
short period (one letter, or up to 64 bytes over and over) nearly every window
would have an anchor of its own. If the run is longer than a window and a period,
all its windows repeat within it: the run is marked at once, and only the windows
of its first period go on, for other texts to be compared with.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import cut_lineage, given_back, others, table, written
from lexloom.llm.textkernel import texts_of

GRAM = 64
#: Neighbouring window starts that are judged by one core.
STEP = 96
#: Bytes of stretches in one shard, about, and of one index, at most (but for a single stretch); how crowds are cut.
SHARD_BYTES, CROWD_BYTES, STEPS = 1_000_000, 250_000, (96, 12, 1)
#: Little work is dealt to all cores, in shards of this many bytes at least.
LEAST_BYTES = 50_000
#: Window starts of a text that are looked at together, and rows that leave a task together.
SEGMENT, ROWS = 1 << 20, 50_000


def grams(text: np.ndarray) -> np.ndarray:
    """Return a 64-bit hash of each substring of GRAM bytes, doubling from 8."""
    raw = np.concatenate([text, np.zeros(8, np.uint8)])
    with np.errstate(over="ignore"):
        x = np.ndarray((len(text) - 7,), "<u8", raw, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        size = 8
        while size < GRAM:
            x = x[:-size] * np.uint64(0xBF58476D1CE4E5B9) + x[size:]
            x ^= x >> np.uint64(29)
            size *= 2
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def anchors(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Return (place, hash, first, last window start) of each anchor of a text of ``length`` bytes or more."""
    g = grams(text)
    width = length - GRAM + 1
    key = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64)
    padded = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(key)] = key
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    count = len(key) - width + 1
    place = (np.minimum(back[:count], ahead[width - 1 : width - 1 + count]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], np.diff(place) != 0]))
    return place[first], g[place[first]], first, np.concatenate([first[1:], [count]]) - 1


def periodic_runs(text: np.ndarray, place: np.ndarray, h: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Return (begin, end, period) of the runs of a period of up to GRAM bytes that are longer than a window and a period.

    In such a run the same substring is chosen again after each period, so
    neighbouring anchors of equal hash say where to look; the bytes decide.
    """
    gap = np.diff(place)
    same = (h[1:] == h[:-1]) & (gap <= GRAM)
    at = np.flatnonzero(same)
    if not len(at):
        return []
    out: list[tuple[int, int, int]] = []
    first = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | (gap[at[1:]] != gap[at[:-1]])]))
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(at)], strict=True):
        period, begin, end = int(gap[at[lo]]), int(place[at[lo]]), int(place[at[hi - 1] + 1]) + GRAM
        if out and end <= out[-1][1]:
            continue
        if (text[begin : end - period] != text[begin + period : end]).any():
            continue
        back = text[max(0, begin - length) : begin] != text[max(0, begin - length) + period : begin + period]
        begin -= int(np.argmax(back[::-1])) if back.any() else len(back)
        more = text[end : end + length] != text[end - period : end - period + len(text[end : end + length])]
        end += int(np.argmax(more)) if more.any() else len(more)
        if end - begin >= length + period:
            out.append((begin, end, period))
    return out


def without(first: np.ndarray, last: np.ndarray, gone: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Return (index, first, last) of what stays of neighbouring ranges when the ranges ``gone`` (in order, ends included) are cut out."""
    bounds = np.array([(a, b) for a, b in gone if a <= b], np.int64).reshape(-1, 2)
    begin = np.concatenate([[first[0]], bounds[:, 1] + 1])
    end = np.concatenate([bounds[:, 0] - 1, [last[-1]]])
    begin, end = begin[begin <= end], end[begin <= end]
    starts = np.unique(np.concatenate([first, begin]))
    part = np.searchsorted(begin, starts, side="right") - 1
    inside = (part >= 0) & (starts <= end[np.maximum(part, 0)])
    starts, part = starts[inside], part[inside]
    which = np.searchsorted(first, starts, side="right") - 1
    return which, starts, np.minimum(last[which], end[part])


def segments(text: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]]:
    """Yield (place, hash, first, last) of the anchors of each segment of a text, and the runs of it that are gone at once."""
    whole = np.frombuffer(text, np.uint8)
    for at in range(0, len(text) - length + 1, SEGMENT):
        part = whole[at : min(at + SEGMENT, len(text) - length + 1) + length - 1]
        place, h, first, last = anchors(part, length)
        runs = periodic_runs(part, place, h, length)
        if runs:
            which, first, last = without(first, last, [(a + period, b - length) for a, b, period in runs])
            place, h = place[which], h[which]
        yield place + at, h, first + at, last + at, [(a + at, b + at) for a, b, _ in runs]


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Return the suffix array of ``t`` (the end sorts first): by 8 bytes, then doubling what is still tied."""
    n = len(t)
    raw = np.concatenate([t, np.zeros(8, np.uint8)])
    key = np.ndarray((n,), ">u8", raw, strides=(1,)).astype(np.uint64)
    sa = np.argsort(key)
    key = key[sa]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), np.arange(n), 0))
    open_ = np.arange(n)
    step = 8
    while len(open_):
        at = sa[open_]
        group = rank[at]
        tied = np.concatenate([group[1:] == group[:-1], [False]])
        tied[1:] |= tied[:-1].copy()
        open_, at, group = open_[tied], at[tied], group[tied]
        if not len(open_):
            break
        then = at + step
        second = np.where(then < n, rank[np.minimum(then, n - 1)] + 1, 0)
        both = group * (n + 1) + second
        order = np.argsort(both)
        at, both = at[order], both[order]
        sa[open_] = at
        fresh = np.concatenate([[True], both[1:] != both[:-1]])
        rank[at] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        step *= 2
    return sa


def common(t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Return the length of the common prefix of the suffixes at ``a`` and ``b``."""
    n = len(t)
    raw = np.concatenate([t, np.zeros(16, np.uint8)])
    wide = np.ndarray((n + 8,), "<u8", raw, strides=(1,))
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        p, q = a[live] + out[live], b[live] + out[live]
        inside = np.maximum(p, q) < n
        live, p, q = live[inside], p[inside], q[inside]
        differ = wide[p] ^ wide[q]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, (np.bitwise_count(low - np.uint64(1)) >> 3).astype(np.int64))
        out[live] += np.minimum(same, n - np.maximum(p, q))
        live = live[same == 8]
    return out


class RunIndex:
    """The run-length BWT of a text: letters and lengths of its runs, and the suffixes at the runs' ends with their neighbours."""

    def __init__(self, t: np.ndarray) -> None:
        self.t = t
        sa = suffix_array(t)
        before = np.where(sa > 0, t[sa - 1], 0)
        edge = (before[1:] != before[:-1]) | (sa[1:] == 0) | (sa[:-1] == 0)
        heads = np.concatenate([[True], edge])
        tails = np.concatenate([edge, [True]])
        self.letters = before[heads]
        self.runs = np.diff(np.concatenate([np.flatnonzero(heads), [len(sa)]]))
        #: Suffixes at the first row of each run with the one above, at the last with the one below (-1: none).
        self.head = np.stack([sa[heads], np.concatenate([[-1], sa[:-1]])[heads]])
        self.tail = np.stack([sa[tails], np.concatenate([sa[1:], [-1]])[tails]])

    def matching(self) -> np.ndarray:
        """Stream, for each position, the length of the longest match that starts anywhere else."""
        n = len(self.t)
        out = np.zeros(n, np.int64)
        for here, other in (self.head, self.tail):
            reach = np.zeros(n, np.int64)
            sampled = np.zeros(n, bool)
            real = other >= 0
            reach[here] = here
            reach[here[real]] += common(self.t, here[real], other[real])
            sampled[here] = True
            last = np.maximum.accumulate(np.where(sampled, np.arange(n), 0))
            np.maximum(out, reach[last] - np.arange(n), out=out)
        return out


def join_spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return the maximal runs of bytes covered by the spans [first, last)."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > last[:-1]]) if len(first) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return first[at], last[np.concatenate([at[1:], [len(first)]]) - 1] if len(at) else last


def matches_in(stretches: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Return, for each distinct stretch, the spans of its strings that start elsewhere in ``stretches`` as well.

    Bytes are raised by one (no UTF-8 text holds 255), so that 0 ends a stretch.
    """
    sizes = np.array([len(s) + 1 for s in stretches])
    begin = np.cumsum(sizes) - sizes
    t = np.frombuffer(b"\xff".join(stretches) + b"\xff", np.uint8) + np.uint8(1)
    found = RunIndex(t).matching()
    end = np.repeat(begin + sizes - 1, sizes)
    size = np.minimum(found, end - np.arange(len(t)))
    hits = np.flatnonzero(size >= length)
    owner = np.searchsorted(begin, hits, side="right") - 1
    bounds = np.searchsorted(owner, np.arange(len(stretches) + 1))
    return [join_spans(hits[a:b] - begin[k], hits[a:b] + size[hits[a:b]] - begin[k]) for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))]


def first_copies(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], bytes]]:
    """Yield the name and the bytes of each different text of a batch of (t1, t2, text)."""
    seen = set()
    for a, b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)), strict=True):
        if (a, b) not in seen:
            seen.add((a, b))
            yield (a, b), text


def as_long(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def name_of(text: Column) -> list[Column]:
    """Return the 128 bits that name a text."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(text, F.lit(1)).alias("t2")]


def cores_of(place: np.ndarray, first: np.ndarray, last: np.ndarray, step: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Return (index, group, begin, end) of the cores of ranges of window starts.

    Window starts are grouped by their distance to the anchor, ``step`` to a
    group; the core of a group is what all its windows have in common.
    """
    low, high = (place - last) // step, (place - first) // step
    index = np.repeat(np.arange(len(place)), high - low + 1)
    group = np.arange(len(index)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[index]
    begin = place[index] - step * group
    return index, group, np.maximum(begin, 0), begin - step + 1 + length


def hashes(text: bytes, begin: np.ndarray, end: np.ndarray, seed: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(text[a:b], k) for a, b, k in zip(begin.tolist(), end.tolist(), seed.tolist(), strict=True)], np.uint64).view(np.int64)


def stretches_of(texts: DataFrame, length: int) -> DataFrame:
    """Return a row for each stretch of the column _text: (t1, t2, first, size, anchor, at, whole, many, cores).

    Copies of a text in one batch are one row with their number as ``many``.
    ``at`` is the anchor's place in the stretch, ``whole`` the stretch's hash with
    that place in it; ``cores`` are the hashes of its cores, each with the steps
    from the anchor. A row without an anchor is a run that repeats within itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = Counter(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            held: list[pa.RecordBatch] = []
            for (a, b), text in first_copies(batch):
                for found in segments(text, length):
                    held.append(_rows(a, b, copies[a, b], text, length, *found))
                    if sum(map(len, held)) > ROWS:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held = []
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return texts.select(*name_of(F.col("_text")), "_text").mapInArrow(run, "t1 long, t2 long, first long, size long, anchor long, at int, whole long, many long, cores array<long>")


def _rows(a: int, b: int, many: int, text: bytes, length: int, place: np.ndarray, h: np.ndarray, first: np.ndarray, last: np.ndarray, runs: list[tuple[int, int]]) -> pa.RecordBatch:
    """Return the rows of one segment of a text, of its stretches and then of its runs."""
    index, group, begin, end = cores_of(place, first, last, STEP, length)
    cores = hashes(text, begin, end, group % (1 << 32))
    whole = hashes(text, first, last + length, place - first)
    more, n = len(runs), len(place)
    run = np.array(runs, np.int64).reshape(-1, 2)
    gone = np.arange(n + more) >= n
    fill = lambda x, y: np.concatenate([x, y])
    none = np.zeros(more, np.int64)
    offsets = fill(np.searchsorted(index, np.arange(n + 1)), np.full(more, len(index)))
    columns = [
        np.full(n + more, a), np.full(n + more, b), fill(first, run[:, 0]), fill(last + length - first, run[:, 1] - run[:, 0]), pa.array(fill(h.view(np.int64), none), mask=gone),
        pa.array(fill(place - first, none).astype(np.int32)), fill(whole, none), np.full(n + more, many), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(cores)),
    ]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["t1", "t2", "first", "size", "anchor", "at", "whole", "many", "cores"])


def finer(step: int, length: int):
    """Return the function that cuts stretches into the texts of their window groups of ``step`` starts.

    From (key, kind, many, at, bytes, anchor, whole, off) it makes the same columns: the new
    key is the old one with the group and its core, the new kind the hash of the
    group's text; ``off`` is its place in the stretch (anchor, whole) that marks go to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            for key, _, many, at, text, anchor, whole, off in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first, last, place = np.array([0]), np.array([len(text) - length]), np.array([at])
                _, group, begin, end = cores_of(place, first, last, step, length)
                for k, lo, hi in zip(group.tolist(), begin.tolist(), end.tolist(), strict=True):
                    from_, to = max(0, at - step * k - step + 1), min(len(text) - length, at - step * k) + length
                    core = xxhash.xxh3_64_intdigest(text[lo:hi], (key ^ (k * 0x9E3779B97F4A7C15)) % 2**64)
                    held.append((as_long(core), as_long(xxhash.xxh3_64_intdigest(text[from_:to], at - from_)), many, at - from_, text[from_:to], anchor, whole, off + from_))
                if len(held) > 4 * ROWS // 10:
                    yield _pieces(held)
                    held = []
            yield _pieces(held)

    return run


UNIT = "key long, kind long, many long, at int, bytes binary, anchor long, whole long, off long"


def _pieces(held: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], t) for k, t in enumerate(types)], [f.split()[0] for f in UNIT.split(", ")])


SPANS = "array<struct<first: bigint, last: bigint>>"


def span(first: Column, last: Column) -> Column:
    return F.array(F.struct(first.cast("long").alias("first"), last.cast("long").alias("last")))


def indexed(units: DataFrame, length: int) -> DataFrame:
    """Return (key, kind, spans) of what the distinct texts (kind, bytes) of each key have in common, by an index for each shard."""
    total = units.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    cores = units.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-total // SHARD_BYTES), min(4 * cores, total // LEAST_BYTES))

    def index(part: pa.Table) -> pa.Table:
        part = part.sort_by([("key", "ascending"), ("kind", "ascending")])
        key, texts = part["key"].to_numpy(), part["bytes"].to_pylist()
        ends = np.flatnonzero(np.concatenate([key[1:] != key[:-1], [True]])) + 1  # keys stay whole
        spans, lo, size = [], 0, 0
        for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            own = sum(map(len, texts[begin:end]))
            if size and size + own > CROWD_BYTES:
                spans += matches_in(texts[lo:begin], length)
                lo, size = begin, 0
            size += own
        spans += matches_in(texts[lo:], length)
        lists = pa.array([[{"first": int(a), "last": int(b)} for a, b in zip(*s, strict=True)] for s in spans], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))
        return pa.table({"key": part["key"], "kind": part["kind"], "spans": lists})

    dealt = units.select("key", "kind", "bytes", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(index, f"key long, kind long, spans {SPANS}").where(F.size("spans") > 0)


def marks_of(content: DataFrame, length: int) -> DataFrame:
    """Return (anchor, whole, spans) of the strings that the distinct stretches of each anchor have in common.

    ``content``: anchor, whole, many, at, bytes. Each round indexes the groups
    that fit and cuts the stretches of the others into finer groups.
    """
    pieces = content.select(F.col("anchor").alias("key"), F.col("whole").alias("kind"), "many", "at", "bytes", "anchor", "whole", F.lit(0).cast("long").alias("off"))
    out = None
    for round_, step in enumerate((None, *STEPS)):
        if step is not None:
            pieces = cut_lineage(pieces.mapInArrow(finer(step, length), UNIT))
        units = cut_lineage(pieces.groupBy("key", "kind").agg(F.sum("many").alias("many"), F.first("bytes").alias("bytes"))) if round_ else pieces
        sizes = cut_lineage(units.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("size"), F.count("*").alias("kinds")).where("kinds > 1"))
        found = indexed(units.join(sizes.where(F.col("size") <= CROWD_BYTES).select("key"), "key", "left_semi"), length)
        if round_:
            found = found.unionByName(units.where("many > 1").select("key", "kind", span(F.lit(0), F.octet_length("bytes")).alias("spans")))
            found = pieces.select("key", "kind", "anchor", "whole", "off").join(found, ["key", "kind"])
            found = found.select("anchor", "whole", F.transform("spans", lambda s: F.struct((s["first"] + F.col("off")).alias("first"), (s["last"] + F.col("off")).alias("last"))).alias("spans"))
        else:
            found = found.select(F.col("key").alias("anchor"), F.col("kind").alias("whole"), "spans")
        out = found if out is None else out.unionByName(found)
        crowds = sizes.where(F.col("size") > CROWD_BYTES).select("key")
        if crowds.isEmpty():
            break
        pieces = pieces.join(crowds, "key", "left_semi")
    return out


def repeated_spans(docs: DataFrame, length: int = 400, text_col: str = "text") -> DataFrame:
    """Return (t1, t2, spans) for each text with bytes covered by a string of ``length`` bytes that also starts elsewhere.

    t1 and t2 name the text (see :func:`name_of`); spans cover such bytes, in any
    order. Null texts count as empty and have none; equal rows are documents of
    their own, whose strings all repeat; an empty table gives no rows. Very long
    texts are read in segments. ``length`` must be at least 2 * GRAM.
    """
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")).where(F.octet_length("_text") >= length)
    found = written(stretches_of(texts, length))
    every = found.where("anchor IS NOT NULL")
    # What is counted by a key is cut off before it is joined on that key: only then can a frequent key's rows be split.
    repeated = cut_lineage(every.groupBy("anchor").agg(F.sum("many").alias("n")).where("n > 1").select("anchor"))
    live = cut_lineage(every.join(repeated, "anchor", "left_semi"))
    # A stretch can hold a repeated string only if one of its cores occurs in another stretch of its anchor.
    shared = cut_lineage(live.select("anchor", "many", F.explode("cores").alias("core")).groupBy("anchor", "core").agg(F.sum("many").alias("n")).where("n > 1").select("anchor", "core"))
    able = cut_lineage(live.select("anchor", "whole", F.explode("cores").alias("core")).join(shared, ["anchor", "core"], "left_semi").select("anchor", "whole").distinct())
    places = cut_lineage(live.drop("cores").join(able, ["anchor", "whole"], "left_semi"))
    kinds = places.groupBy("anchor", "whole").agg(F.sum("many").alias("many"), F.first("at").alias("at"), F.first(F.struct("t1", "t2", "first", "size")).alias("place"))
    kinds = cut_lineage(kinds.select("anchor", "whole", "many", "at", "place.*"))
    crowd = cut_lineage(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor"))
    wanted = kinds.join(crowd, "anchor")
    # The bytes of one stretch of each kind, from the texts that hold them.
    per_text = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("first", "size", "anchor", "whole", "many", "at")).alias("wanted"))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, held = zip(*first_copies(batch), strict=True) if len(batch) else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()), pa.array(held, pa.binary())], ["t1", "t2", "_bytes"])

    keyed = texts.select(*name_of(F.col("_text")), "_text").mapInArrow(once, "t1 long, t2 long, _bytes binary")
    held = keyed.join(per_text, ["t1", "t2"]).select("_bytes", F.explode("wanted").alias("a"))
    content = held.select("a.anchor", "a.whole", "a.many", "a.at", F.substring(F.col("_bytes"), F.col("a.first").cast("int") + 1, F.col("a.size").cast("int")).alias("bytes"))
    content = cut_lineage(content.groupBy("anchor", "whole", "many", "at").agg(F.first("bytes").alias("bytes")))
    as_whole = kinds.where("many > 1").select("anchor", "whole", span(F.lit(0), F.col("size")).alias("spans"))
    marks = marks_of(content, length).unionByName(as_whole)
    on_texts = places.select("anchor", "whole", "t1", "t2", F.col("first").alias("from")).distinct().join(marks, ["anchor", "whole"])
    moved = on_texts.select("t1", "t2", F.transform("spans", lambda s: F.struct((s["first"] + F.col("from")).alias("first"), (s["last"] + F.col("from")).alias("last"))).alias("spans"))
    within = found.where("anchor IS NULL").select("t1", "t2", span(F.col("first"), F.col("first") + F.col("size")).alias("spans"))
    return moved.unionByName(within).groupBy("t1", "t2").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def without_repeats(docs: DataFrame, length: int = 400, text_col: str = "text") -> DataFrame:
    """Return ``docs`` with _bytes, _spans (maximal, in order) and _kept (the other bytes, joined).

    Columns of ``docs`` that have these names are replaced.
    """
    row, names = others(docs, ("_bytes", "_spans", "_kept"), [text_col])
    spans = repeated_spans(docs, length, text_col)
    one, two = name_of(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    slim = docs.select(row, F.col(text_col).alias("text"), one, two).join(spans, ["t1", "t2"], "left").select("row", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, lists, kept = [], [], []
            for text, marks in zip(texts_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                marks = marks or []
                first, last = join_spans(np.array([m["first"] for m in marks], np.int64), np.array([m["last"] for m in marks], np.int64))
                cut = [0, *np.stack([first, last], 1).ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(cut[::2], cut[1::2], strict=True)))
                sizes.append(len(text))
                lists.append([{"first": a, "last": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(lists, kind), pa.array(kept, pa.binary())], ["row", "text", "_bytes", "_spans", "_kept"])

    schema = ", ".join([f"{c} {slim.schema[c].dataType.simpleString()}" for c in ("row", "text")] + [f"_bytes long, _spans {SPANS}, _kept binary"])
    return slim.mapInArrow(run, schema).select(*given_back(names, {text_col: F.col("text")}), "_bytes", "_spans", "_kept")


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What is removed of every document, and the hash of what is left."""
    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"])
    return found.select("doc_id", F.col("_bytes").alias("n_bytes"), removed.alias("n_removed"), F.size("_spans").cast("long").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))
