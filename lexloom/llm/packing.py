"""Packing token sequences by the sum-of-squares rule.

Documents are cut into pieces of at most ``capacity`` tokens. Pieces go, by a
hash, to blocks that are packed apart from one another, each large enough for its
few half-empty sequences not to matter. In a block each piece is placed where the
sum over all residual gaps of the squared number of open bins with that gap
becomes smallest (Csirik et al., 2006): this keeps bins of all gaps at hand. Pieces
come largest first and a new sequence is opened only where no open one has room.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import cut_lineage, spread, table

CAPACITY = 1024
END_OF_DOCUMENT = 2
#: Pieces that are packed together, about.
BLOCK_ROWS = 150_000

_encodings: dict[str, object] = {}


def encoding(path: str):
    """Return an encoder for a byte-level BPE vocabulary: (text) -> ids.

    A ``.json`` file is read by tokenizers. Where the file beside it has the
    same vocabulary as ranks (``.tiktoken``), tiktoken encodes with that, to the
    same ids (a test compares them) at several times the speed. The vocabulary's
    special token in a text becomes its own id, as with tokenizers.
    """
    if path not in _encodings:
        ranks_path = path.removesuffix(".json") + ".tiktoken"
        try:
            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        except FileNotFoundError:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            _encodings[path] = lambda text: whole.encode(text, add_special_tokens=False).ids
            return _encodings[path]
        import public_tokenizers
        import tiktoken

        special = {"<|endoftext|>": len(ranks)}
        bpe = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        _encodings[path] = lambda text: bpe.encode(text, allowed_special="all", disallowed_special=())
    return _encodings[path]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Return (start, length) of the pieces of ``n`` tokens; only the first may be shorter than ``capacity``."""
    if n <= capacity:
        return [(0, n)]
    head = n - capacity * ((n - 1) // capacity)
    return [(0, head), *((at, capacity) for at in range(head, n, capacity))]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Return one row for each piece: id, piece, start, length, ids_crc32 and, if asked for, the ids.

    Null texts count as empty (one piece of one token); rows whose id is null or
    repeats are documents of their own; a text of any length is encoded whole,
    so that its ids must fit in one worker's memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), END_OF_DOCUMENT], "<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows.append((key, k, start, length, zlib.crc32(part.tobytes()), part.astype(np.int32) if with_ids else None))
            names = ["id", "piece", "start", "length", "ids_crc32", "ids"]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            last = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays(columns[:last], names[:last])

    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return spread(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))).mapInArrow(run, schema)


def place(sizes: np.ndarray, capacity: int = CAPACITY, sparing: bool = False) -> np.ndarray:
    """Return the bin of each size, in turn, by the sum-of-squares rule; ties go to the smallest gap.

    The rule weighs a new bin against the open ones. With ``sparing`` a new bin
    is opened only for a size that no open bin has room for.
    """
    open_ = np.zeros(capacity + 1, np.int64)  # bins by gap
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), np.int64)
    bins = 0
    never = np.iinfo(np.int64).max
    for k, size in enumerate(sizes.tolist()):
        gaps = open_[size:]
        cost = np.where(gaps > 0, 2 * (open_[: capacity + 1 - size] - gaps) + 2, never)
        if gaps[0]:
            cost[0] = 1 - 2 * gaps[0]
        cost[-1] = (never - 1 if sparing else 2 * open_[capacity - size] + 1) if size < capacity else 0  # a new bin
        gap = size + int(cost.argmin())
        if gap == capacity:
            at, bins = bins, bins + 1
        else:
            at = stacks[gap].pop()
            open_[gap] -= 1
        if gap > size:
            stacks[gap - size].append(at)
            open_[gap - size] += 1
        out[k] = at
    return out


def pack(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Return the bin of each size: by the sum-of-squares rule among the open bins, the largest size first.

    The rule was made for sizes that keep coming, for which it opens bins of all
    gaps in advance; here all sizes are known, and bins that stay open are
    waste, so a new one is opened only where no open bin has room.
    """
    order = np.argsort(-sizes, kind="stable")
    out = np.empty(len(sizes), np.int64)
    out[order] = place(sizes[order], capacity, sparing=True)
    return out


def offsets(bins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Return the place of each size in its bin, gapless, in the order given."""
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(sizes[order])
    begins = ends - sizes[order]
    first = np.concatenate([[True], np.diff(bins[order]) > 0]) if len(bins) else np.zeros(0, bool)
    base = begins[first][np.cumsum(first) - 1] if len(bins) else begins
    out = np.empty(len(sizes), np.int64)
    out[order] = begins - base
    return out


def packed(cut_pieces: DataFrame, capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Return ``cut_pieces`` (of :func:`pieces`) with sequence_id and offset.

    Pieces of full length are sequences of their own. A document without text is
    one piece of one token; rows with equal ids are packed one by one; an empty
    table gives no rows.
    """
    cut_pieces = cut_lineage(cut_pieces)
    names = [c for c in cut_pieces.columns if c != "ids"]
    full = cut_pieces.where(F.col("length") == capacity)
    full = full.withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    part = cut_pieces.where(F.col("length") < capacity)
    count = max(1, -(-part.count() // block_rows))

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("length", "descending"), ("id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        sizes = block["length"].to_numpy()
        where = pack(sizes, capacity)
        number = (block["block"].to_numpy() << 36) + where
        return block.drop_columns("block").append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offsets(where, sizes)))

    hashed = part.withColumn("block", F.pmod(F.xxhash64(*names), F.lit(count)))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in part.schema.fields] + ["sequence_id long", "offset long"])
    return full.unionByName(hashed.groupBy("block").applyInArrow(run, schema))


def vocabulary_path() -> str:
    """Return the place of the public byte-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    return packed(pieces(table(spark, sf_dir, "documents"), vocabulary_path())).withColumnRenamed("id", "doc_id")
