"""Token ids in files, coded by a canonical length-limited Huffman code.

A file is a Parquet part of ``<path>/segments``, whose rows are segments: runs of
whole documents in ascending ``doc_id`` order (null first), each with its
documents' ids, their numbers of tokens, the code stream and the bit offset of
every ``BLOCK``-th token. Blocks start at these checkpoints, so all blocks of a
segment are decoded side by side, by one look-up in a table of 2^max_bits
entries per token. ``<path>/lengths`` holds the code lengths, which are all that
a canonical code needs, and ``<path>/ranges`` where each range of documents starts.

The code comes from the numbers of every id in the whole corpus. Null texts are
empty and hold the end id alone. Rows with equal or null ``doc_id`` are kept,
each as a document, in any order among themselves; many of one id are dealt out to several ranges. An empty table gives empty files.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm.tables import documents, drop_folder, shuffle_partitions, slices
from starloom.llm.token_ids import encoder
from starloom.session import new_folder
from starloom.sources.files import read_parquet

BLOCK = 128
SEGMENT = "range int, start long, doc_ids array<long>, n_tokens array<int>, payload binary"


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Lengths of an optimal code of at most ``max_bits`` bits, by package-merge; 0 for ids that do not occur."""
    ids = np.flatnonzero(counts)
    if len(ids) > 1 << max_bits:
        raise ValueError(f"{len(ids)} ids need more than {max_bits} bits")
    lengths = np.zeros(len(counts), np.uint8)
    if len(ids) < 2:
        lengths[ids] = 1
        return lengths
    ids = ids[np.argsort(counts[ids], kind="stable")]
    weights = counts[ids].astype(np.int64)
    n, chosen = len(ids), []
    level = weights
    is_leaf = np.ones(n, bool)
    for _ in range(max_bits):
        chosen.append(is_leaf)
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        level, is_leaf = both[order], order < n
    take = 2 * n - 2
    # Of each level the first `take` entries count; its packages stand for twice as many entries one level down.
    for is_leaf in reversed(chosen):
        leaves = int(is_leaf[:take].sum())
        lengths[ids[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes that ascend by length and then by id, moved up to the highest bit of 64."""
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    for i in sorted(np.flatnonzero(lengths).tolist(), key=lambda i: (lengths[i], i)):
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code << (64 - last)
        code += 1
    return codes


def decoding_table(lengths: np.ndarray, max_bits: int) -> np.ndarray:
    """For every window of ``max_bits`` bits the id at its front, and in the lower eight bits that id's code length."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    each = 1 << (max_bits - lengths[ids].astype(np.int64))
    table = np.ones(1 << max_bits, np.uint32)
    used = int(each.sum())
    table[:used] = np.repeat(ids.astype(np.uint32) << 8 | lengths[ids], each)
    return table


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The code stream of ``ids`` and the bit offset of every ``BLOCK``-th of them. ``codes`` start at the highest bit."""
    ends = np.cumsum(lengths[ids], dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    out = np.zeros(total // 64 + 2, np.uint64)
    starts = np.concatenate([[0], ends[:-1]])
    if len(ids):
        word, code = starts >> 6, codes[ids]
        # Bits of one word are disjoint, so adding them up is joining them.
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        shift = (starts & 63).astype(np.uint64)
        out[word[first]] = np.add.reduceat(code >> shift, first)
        # The last code of a word may go on in the next one.
        over = np.flatnonzero((ends - 1) >> 6 != word)
        out[word[over] + 1] |= code[over] << (np.uint64(64) - shift[over])
    return out.astype(">u8").tobytes()[: (total + 7) // 8], starts[: len(ids) : BLOCK]


def unpack_bits(stream: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray) -> np.ndarray:
    """The ``n`` ids of a code stream; all blocks advance together, one id each in a step."""
    max_bits = (len(table) - 1).bit_length()
    raw = np.frombuffer(stream + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at, mask = checkpoints.astype(np.uint32), np.uint32((1 << max_bits) - 1)
    seven, up, low = np.uint32(7), np.uint32(32 - max_bits), np.uint32(255)
    out = np.zeros((BLOCK, len(at)), np.uint32)
    last = n - BLOCK * (len(at) - 1) if len(at) else 0
    for step in range(min(BLOCK, n)):
        if step == last:
            at = at[:-1]
        found = table[window[at >> np.uint32(3)] >> (up - (at & seven)) & mask]
        out[step, : len(at)] = found
        at = at + (found & low)
    return (out >> np.uint32(8)).T.ravel()[:n]


@dataclass(frozen=True)
class Ranges:
    """Ranges of ids of about as many rows each. Rows without id come first; an id at several cuts has as many ranges."""

    cuts: np.ndarray
    without_id: int

    def numbers(self, ids: pa.Array, at: int) -> np.ndarray:
        """The range of each row; ``at`` is the first one's place in its task, by which rows of one id or none are dealt out."""
        known = np.asarray(ids.is_valid())
        values, turn = np.asarray(ids.fill_null(0)), np.arange(at, at + len(ids))
        low, high = np.searchsorted(self.cuts, values, "left"), np.searchsorted(self.cuts, values, "right")
        spread = np.where(high - low > 1, low + 1 + turn % np.maximum(1, high - low), high)
        return np.where(known, self.without_id + spread, turn % max(1, self.without_id))


def _ranges(docs: DataFrame, n: int) -> Ranges:
    """``n`` ranges of the documents; reads the ids alone."""
    rows, known = docs.select(F.count(F.lit(1)), F.count("doc_id")).first()
    without_id = n if not known else min(n - 1, round(n * (rows - known) / rows))
    parts = n - without_id
    cuts = docs.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else None
    return Ranges(np.array(cuts or [], np.int64), without_id)


def _id_type(tokenizer_path: str) -> str:
    """The narrower of two and four bytes that holds all ids of the vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else "<u4"


def _binary(data: bytes, sizes: np.ndarray) -> pa.Array:
    """Consecutive parts of ``data`` as a binary column."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _encode_texts(tokenizer_path: str, ranges: Ranges, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = encoder(tokenizer_path), TaskContext.get().partitionId()
        for part in slices(batches, "text"):
            ids, lengths = own.encode(part.column("text"))
            raw = ids.astype(kind)
            ids_of = part.column("doc_id")
            numbers = ranges.numbers(ids_of, at)
            at += len(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers, pa.int32()), ids_of, pa.array(lengths, pa.int32()),
                    _binary(raw.tobytes(), lengths * raw.itemsize),
                ],
                ["range", "doc_id", "n_tokens", "ids"],
            )

    return run


def _gather(segment_tokens: int):
    """Sorted documents of one range after the other to segments, with the tokens before each within its range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begin, docs, counts, ids, size = None, 0, [], [], [], 0
        press = zstandard.ZstdCompressor(level=1)

        def flush() -> pa.RecordBatch:
            # Low bytes first, then the higher ones: bytes of a kind compress better together.
            flat = b"".join(ids)
            planes = np.frombuffer(flat, np.uint8).reshape(size, -1).T
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([current], pa.int32()),
                    pa.array([begin], pa.int64()),
                    pa.array([docs], pa.list_(pa.int64())),
                    pa.array([counts], pa.list_(pa.int32())),
                    pa.array([press.compress(planes.tobytes())], pa.binary()),
                ],
                ["range", "start", "doc_ids", "n_tokens", "payload"],
            )

        for batch in batches:
            for number, doc, n, own in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if docs and (number != current or size + n > segment_tokens):
                    yield flush()
                    begin, docs, counts, ids, size = begin + size if number == current else 0, [], [], [], 0
                elif number != current:
                    begin = 0
                current = number
                docs.append(doc)
                counts.append(n)
                ids.append(own)
                size += n
        if docs:
            yield flush()

    return run


def _plain_ids(payload: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _histogram(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for payload in batch.column("payload"):
                own = np.bincount(_plain_ids(payload.as_py(), kind), minlength=len(total))
                own[: len(total)] += total
                total = own
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["token", "n"])

    return run


def _encode_segments(lengths: np.ndarray, codes: np.ndarray, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            streams, points = [], []
            for payload in batch.column("payload"):
                stream, at = pack_bits(_plain_ids(payload.as_py(), kind), codes, lengths)
                streams.append(stream)
                points.append(at.astype(np.int32))
            kept = [batch.column(n) for n in ("range", "start", "doc_ids", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(streams, pa.binary()), pa.array(points, pa.list_(pa.int32()))],
                ["range", "start", "doc_ids", "n_tokens", "stream", "checkpoints"],
            )

    return run


FILES = "range int, start long, doc_ids array<long>, n_tokens array<int>, stream binary, checkpoints array<int>"


def write_ids(
    docs: DataFrame, path: str, tokenizer_path: str, max_bits: int = 16, segment_tokens: int = 1 << 18
) -> None:
    """Encode all texts, count their ids, and write them to ``path``.

    Each text is encoded once; its ids go to the range of its ``doc_id`` and wait
    there, in a folder that is removed in the end, until all ids are counted.
    The driver sees one number per id of the vocabulary and one per range.
    """
    spark, docs = docs.sparkSession, documents(docs)
    n, kind = shuffle_partitions(spark), _id_type(tokenizer_path)
    plain_path = new_folder(spark, "token-ids")
    try:
        encoded = docs.mapInArrow(
            _encode_texts(tokenizer_path, _ranges(docs, n), kind), "range int, doc_id long, n_tokens int, ids binary"
        )
        (
            encoded.repartitionById(n, F.col("range"))
            .sortWithinPartitions("range", "doc_id", "ids")
            .mapInArrow(_gather(segment_tokens), SEGMENT)
            .write.option("compression", "uncompressed")
            .parquet(plain_path)
        )
        plain = read_parquet(spark, plain_path, spark.createDataFrame([], SEGMENT).schema)
        found = plain.mapInArrow(_histogram(kind), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros(max((r["token"] for r in found), default=0) + 1, np.int64)
        for r in found:
            counts[r["token"]] = r["n"]
        lengths = code_lengths(counts, max_bits)
        table = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
        spark.createDataFrame(table, "token int, bits int").coalesce(1).write.parquet(f"{path}/lengths")
        sizes = plain.groupBy("range").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
        before, ranges = 0, []
        for r in sorted(sizes.collect(), key=lambda r: r["range"]):
            ranges.append((r["range"], before, max_bits))
            before += r["n"]
        spark.createDataFrame(ranges, "range int, tokens_before long, max_bits int").coalesce(1).write.parquet(f"{path}/ranges")
        coded = plain.mapInArrow(_encode_segments(lengths, canonical_codes(lengths), kind), FILES)
        coded.write.option("compression", "uncompressed").parquet(f"{path}/segments")
    finally:
        drop_folder(spark, plain_path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document from files of ``write_ids``; ids as little-endian 32-bit numbers."""
    ranges = read_parquet(spark, f"{path}/ranges", spark.createDataFrame([], "range int, tokens_before long, max_bits int").schema)
    table = read_parquet(spark, f"{path}/lengths", spark.createDataFrame([], "token int, bits int").schema)
    # At most one row per shuffle partition and one per id of the vocabulary.
    found, code = ranges.collect(), table.collect()
    before, max_bits = {r["range"]: r["tokens_before"] for r in found}, found[0]["max_bits"] if found else 1
    lengths = np.zeros(max((r["token"] for r in code), default=0) + 1, np.uint8)
    for r in code:
        lengths[r["token"]] = r["bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = decoding_table(lengths, max_bits)
        for part in slices(batches, "stream", 1 << 20):
            rows = zip(*(part.column(i) for i in range(6)), strict=True)
            for number, start, doc_ids, n_tokens, stream, points in rows:
                counts = np.asarray(n_tokens.values, np.int64)
                ids = unpack_bits(stream.as_py(), np.asarray(points.values), int(counts.sum()), symbols)
                ends = np.cumsum(counts)
                begin = before[number.as_py()] + start.as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.values,
                        pa.array(begin + ends - counts),
                        pa.array(counts),
                        _binary(ids.astype("<u4").tobytes(), 4 * counts),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    files = read_parquet(spark, f"{path}/segments", spark.createDataFrame([], FILES).schema)
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
