"""Removal of repeated substrings of `length` words, by difference-cover anchors.

Two positions p, q of equal runs of `length` words have, for a cover D of the residues modulo m, a shift d < m with
(p + d) mod m and (q + d) mod m both in D.  So it is enough to hash windows of length - m + 1 words at the positions
whose residue is in D: any long match shares an aligned anchor.  Matched anchors are then extended: the windows of
`length` words that hold one are hashed (128 bits) and met in turn, which decides exactly.

Both meetings work alike.  A task hashes its texts, resolves what repeats within itself, and sends each distinct hash
once, packed by hash bucket; a bucket finds the hashes that came twice (or came marked as repeated) and answers the
positions, packed by text.  So a hash that a third of all texts share is one entry a task, buckets hold about
`bucket_bytes` of text each, and what texts get back is intervals of positions.

Defined cases: null texts have no words; texts shorter than `length` words are kept whole; rows that repeat count as
occurrences of each other and get equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASES, bounded_batches, materialise, text_chunks, window_hashes, word_hashes

#: Perfect difference set modulo 21: every residue is a difference of two of these.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
#: Hashes that a task gathers before it sends them.
GATHER = 1_000_000


# ---- packing ---------------------------------------------------------------------------------------------------


def merge_intervals(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by doc, overlapping and adjoining intervals (ends inclusive) of a doc as one."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    # the running maximum of ends must restart at each doc: docs are shifted apart
    shift = (np.cumsum(first) - 1) * (int(hi.max()) + 2)
    reach = np.maximum.accumulate(hi + shift)
    new = first.copy()
    new[1:] |= (lo + shift)[1:] > reach[:-1] + 1
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(doc)) - 1
    return doc[heads], lo[heads], (reach - shift)[tails]


def pack_intervals(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> bytes:
    """doc is sorted."""
    head = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    counts = np.diff(np.append(head, len(doc))).astype(np.uint32)
    body = np.array([len(head), len(doc)], np.int64).tobytes() + doc[head].tobytes() + counts.tobytes() + np.diff(lo, prepend=0).astype(np.int32).tobytes() + (hi - lo).astype(np.uint32).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack_intervals(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    m, n = np.frombuffer(body, np.int64, 2)
    at = 16
    keys = np.frombuffer(body, np.int64, m, at)
    counts = np.frombuffer(body, np.uint32, m, at + 8 * m)
    step = np.frombuffer(body, np.int32, n, at + 12 * m)
    lo = np.cumsum(step.astype(np.int64))
    hi = lo + np.frombuffer(body, np.uint32, n, at + 12 * m + 4 * n)
    return np.repeat(keys, counts), lo, hi


def hit_rows(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """(text bucket, packed intervals)."""
    doc, lo, hi = merge_intervals(doc, lo, hi)
    target = (doc.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    cut = np.flatnonzero(np.diff(target[order], prepend=-1))
    for a, b in zip(cut, np.append(cut[1:], len(order))):
        at = order[a:b]
        yield int(target[at[0]]), pack_intervals(doc[at], lo[at], hi[at])


# ---- the meeting -----------------------------------------------------------------------------------------------


def _runs(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal hashes together, and which places of it begin a run."""
    order = np.lexsort(hashes[::-1]) if len(hashes) > 1 else np.argsort(hashes[0], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = np.any([h[order[1:]] != h[order[:-1]] for h in hashes], axis=0) if len(order) > 1 else []
    return order, new


def ask_rows(hashes: list[np.ndarray], doc: np.ndarray, pos: np.ndarray, before: int, buckets: int, doc_buckets: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(bucket, kind, text bucket, packed): kind 1 are hits found here, kind 0 asks about each distinct hash once."""
    order, new = _runs(hashes)
    run = np.cumsum(new) - 1
    size = np.bincount(run) if len(run) else np.zeros(0, np.int64)
    here = order[size[run] > 1]
    for target, blob in hit_rows(doc[here], np.maximum(pos[here] - before, 0), pos[here], doc_buckets):
        yield target % buckets, 1, target, blob
    first, multi = order[new], size > 1
    bucket = (hashes[0][first] % np.uint64(buckets)).astype(np.int64)
    place = np.lexsort((pos[first], doc[first], bucket))
    first, multi, bucket = first[place], multi[place], bucket[place]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(cut, np.append(cut[1:], len(first))):
        at = first[a:b]
        spots = pack_intervals(doc[at], pos[at], pos[at])
        yield int(bucket[a]), 0, 0, np.int64(b - a).tobytes() + b"".join(h[at].tobytes() for h in hashes) + multi[a:b].tobytes() + spots


def answer(blobs: list[bytes], width: int, before: int, doc_buckets: int) -> Iterator[tuple[int, bytes]]:
    """From all asks of a bucket, the hits of hashes that occur more than once (those marked repeated are known)."""
    hashes: list[list[np.ndarray]] = [[] for _ in range(width)]
    multis, docs, spots = [], [], []
    for blob in blobs:
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        for j in range(width):
            hashes[j].append(np.frombuffer(blob, np.uint64, n, 8 + 8 * n * j))
        multis.append(np.frombuffer(blob, bool, n, 8 + 8 * n * width))
        doc, lo, _ = unpack_intervals(blob[8 + 8 * n * width + n :])
        docs.append(doc)
        spots.append(lo)
    flat, multi, doc, pos = [np.concatenate(h) for h in hashes], np.concatenate(multis), np.concatenate(docs), np.concatenate(spots)
    order, new = _runs(flat)
    run = np.cumsum(new) - 1
    hit = (np.bincount(run)[run] > 1) & ~multi[order]
    at = order[hit]
    yield from hit_rows(doc[at], np.maximum(pos[at] - before, 0), pos[at], doc_buckets)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows (first column the key, sorted) by key."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != key and held:
                yield key, held
                held = []
            key = row[0]
            held.append(row[1:])
    if held:
        yield key, held


def _meet(asks: DataFrame, width: int, before: int, buckets: int, doc_buckets: int) -> DataFrame:
    """(_key, _lo, _hi) of every text with hits, from rows of ask_rows."""
    spark = asks.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-buckets // 4))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches):
            out = [(target, blob) for kind, target, blob in rows if kind == 1]
            if open_ := [blob for kind, _, blob in rows if kind == 0]:
                out += answer(open_, width, before, doc_buckets)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], names=["target", "blob"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches):
            parts_ = [unpack_intervals(blob) for (blob,) in rows]
            doc, lo, hi = merge_intervals(*(np.concatenate(x) for x in zip(*parts_)))
            head = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            offs = pa.array(np.append(head, len(doc)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offs, pa.array(x.astype(np.int32))) for x in (lo, hi)]
            yield pa.RecordBatch.from_arrays([pa.array(doc[head]), *lists], names=["_key", "_lo", "_hi"])

    met = asks.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(reduce, "target long, blob binary")
    return met.repartition(parts, "target").sortWithinPartitions("target").mapInArrow(gather, "_key long, _lo array<int>, _hi array<int>")


ASK = "bucket long, kind int, target long, blob binary"


def _asker(hash_spots, width: int, before: int, buckets: int, doc_buckets: int):
    """mapInArrow function that gathers (hashes, key, position) of texts and sends them in large pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0

        def send() -> pa.RecordBatch:
            hashes = [np.concatenate([x[0][j] for x in held]) for j in range(width)]
            doc, pos = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
            held.clear()
            rows = list(ask_rows(hashes, doc, pos, before, buckets, doc_buckets))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "kind", "target", "blob"])

        for batch in batches:
            keys = batch.column(0).to_numpy()
            for a, b, buf, offs in text_chunks(batch.column(1)):
                words, first, _ = word_hashes(buf, offs)
                spots = hash_spots(words, first, keys[a:b], batch, a, b)
                if len(spots[1]):
                    held.append(spots)
                    n += len(spots[1])
                if n >= GATHER:
                    yield send()
                    n = 0
        if held:
            yield send()

    return run


def _positions(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of `length` words inside one text: text, position in it, position in all words."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    total = np.cumsum(counts)
    pos = np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - counts, counts)
    return owner, pos, pos + first[owner]


def repeated_windows(docs: DataFrame, length: int = 35, bucket_bytes: int = 32 << 20, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """(_key, _lo, _hi): starts of the windows of docs (_key, _text) whose words occur elsewhere too, as intervals."""
    if length < PERIOD:
        raise ValueError(f"windows of under {PERIOD} words have no anchors")
    anchor = length - PERIOD + 1
    in_cover = np.isin(np.arange(PERIOD), COVER)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(64, -(-total // bucket_bytes))

    def anchors(words, first, keys, batch, a, b):
        h = window_hashes(words, anchor, BASES[0])
        owner, pos, at = _positions(first, anchor)
        long_enough = np.diff(first)[owner] >= length
        pick = in_cover[pos % PERIOD] & long_enough
        return [h[at[pick]]], keys[owner[pick]], pos[pick]

    def candidates(words, first, keys, batch, a, b):
        los, his = batch.column(2).slice(a, b - a), batch.column(3).slice(a, b - a)
        owner, pos, at = _positions(first, length)
        counts = np.maximum(np.diff(first) - length + 1, 0)
        begin = np.cumsum(counts) - counts
        mark = np.zeros(len(pos) + 1, np.int64)
        for r in range(b - a):
            lo, hi = np.asarray(los[r].values), np.asarray(his[r].values)
            ok = lo < counts[r]
            np.add.at(mark, begin[r] + lo[ok], 1)
            np.add.at(mark, begin[r] + np.minimum(hi[ok] + 1, counts[r]), -1)
        pick = np.cumsum(mark[:-1]) > 0
        at = at[pick]
        return [window_hashes(words, length, base)[at] for base in BASES], keys[owner[pick]], pos[pick]

    found = _meet(docs.mapInArrow(_asker(anchors, 1, PERIOD - 1, buckets, buckets), ASK), 1, PERIOD - 1, buckets, buckets)
    found = sized_broadcast(materialise(found, "anchors"), broadcast_bytes)
    near = docs.join(found.withColumnRenamed("_key", "_k"), F.col("_key") == F.col("_k")).select("_key", "_text", "_lo", "_hi")
    return _meet(near.mapInArrow(_asker(candidates, 2, 0, buckets, buckets), ASK), 2, 0, buckets, buckets)


def sized_broadcast(hits: DataFrame, most: int) -> DataFrame:
    """A written table of intervals, marked for broadcast where it is small enough."""
    n = hits.agg(F.coalesce(F.sum(40 + 8 * F.size("_lo")), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(hits) if n <= most else hits


def remove_repeats(docs: DataFrame, length: int = 35, bucket_bytes: int = 32 << 20, broadcast_bytes: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row, with the kept text too if asked for."""
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    keyed = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"), F.col(text_col).alias("_text"), F.col(id_col).alias("_id"))
    hits = sized_broadcast(materialise(repeated_windows(keyed.select("_key", "_text"), length, bucket_bytes, broadcast_bytes), "repeats"), broadcast_bytes)
    joined = keyed.join(hits.withColumnRenamed("_key", "_k"), F.col("_key") == F.col("_k"), "left").select("_id", "_text", "_lo", "_hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [id_col, "n_words", "n_removed", "kept_sha256", *(["text"] if with_text else [])]
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                n_words, n_removed, sums, texts = [], [], [], []
                for x, lo, hi in zip(part.column(1).cast(pa.large_binary()), part.column(2), part.column(3)):
                    words = (x.as_py() or b"").split()
                    n_words.append(len(words))
                    kept, at = [], 0
                    for p, q in zip(lo.as_py() or (), hi.as_py() or ()):
                        kept += words[at:p] if p > at else []
                        at = max(at, q + length)
                    kept = kept + words[at:] if at else words
                    n_removed.append(len(words) - len(kept))
                    joined_ = b" ".join(kept)
                    sums.append(hashlib.sha256(joined_).hexdigest())
                    if with_text:
                        texts.append(joined_.decode())
                columns = [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sums, pa.string())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(texts, pa.string())] if with_text else []), names=names)

    return joined.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else ""))
