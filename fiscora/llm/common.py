"""Shared pieces of the training-data operators: scratch tables and vectorised word hashing.

Words are `[^\\x20\\x09-\\x0D]+` throughout.  Texts arrive as Arrow batches; the byte buffer of a batch is
hashed with numpy in chunks of bounded size, so memory does not follow the batch or the corpus.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text hashed at a time (one longer text is a chunk of its own).
CHUNK_BYTES = 1 << 20
#: Longer words are hashed by blake2b instead of the position table.
LONG_WORD = 1024

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, LONG_WORD, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Where it is unset, only a local session (one process, which has a single disk) gets a folder of its own; a cluster
    raises, as no folder of one machine can be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is unset: tables between stages need a folder that all executors share")
        root = f"file://{spark._jvm.System.getProperty('java.io.tmpdir')}/fiscora-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/fiscora/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write a table into the shared folder and read it back, so lost executors cost no recompute."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Arrow batches are cut by bytes too, so that very long texts do not fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def sample_share(df: DataFrame, id_col: str, bound: int) -> DataFrame:
    """About `bound` rows at most, chosen by a hash of the id: the same rows in every run."""
    n = df.count()
    if n <= bound:
        return df
    keep = int(bound / n * (1 << 31))
    return df.filter((F.hash(F.lit(7), F.col(id_col)).cast("long") + (1 << 31)) < 2 * keep)


def fitting(name: str, taken) -> str:
    """A column name that no column of `taken` has."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of rows in them) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + max_bytes, "right")) - 1)
        b = min(b, n)
        yield a, b, buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


def word_hashes(buf: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words, the index of each row's first word (with the end), and the words' starts."""
    n = len(buf)
    rows = len(offs) - 1
    if not n:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64), np.zeros(0, np.int64)
    if lower:
        buf = _LOWER[buf]
    space = _SPACE[buf]
    start = ~space
    start[1:] &= space[:-1]
    cut = offs[:-1][(offs[:-1] < n) & (offs[1:] > offs[:-1])]
    start[cut] = ~space[cut]
    starts = np.flatnonzero(start)
    first = np.searchsorted(starts, offs)
    if not len(starts):
        return np.zeros(0, np.uint64), first, starts
    place = np.arange(n, dtype=np.int64)
    spans = np.diff(np.append(starts, n))
    lead = starts[0]
    place[lead:] -= np.repeat(starts, spans)
    np.bitwise_and(place, LONG_WORD - 1, out=place)
    part = _BYTE[buf]
    part *= _PLACE[place]
    part[space] = 0
    h = np.add.reduceat(part, starts)
    for i in np.flatnonzero(spans >= LONG_WORD):
        end = starts[i] + spans[i]
        word = buf[starts[i] : end]
        gap = np.flatnonzero(space[starts[i] : end])
        word = word[: gap[0]] if len(gap) else word
        row_end = offs[np.searchsorted(offs, starts[i], "right")]
        word = word[: row_end - starts[i]]
        if len(word) >= LONG_WORD:
            h[i] = np.frombuffer(hashlib.blake2b(word.tobytes(), digest_size=8).digest(), np.uint64)[0]
    return mix(h), first, starts


def window_hashes(words: np.ndarray, k: int, base: np.uint64) -> np.ndarray:
    """Hash of the k words from each position on; the last k - 1 positions have none."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64)
    power = np.full(n + 1, base, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * power[1:], out=total[1:])
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    back = np.full(n - k + 1, inverse, np.uint64)
    np.multiply.accumulate(back, out=back)
    return mix((total[k:] - total[: n - k + 1]) * back)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its k-word shingles, lower-cased A-Z); fewer words are one shingle, none is empty."""
    for a, b, buf, offs in text_chunks(column):
        words, first, _ = word_hashes(buf, offs, lower=True)
        wins = window_hashes(words, k, BASES[0])
        for r in range(b - a):
            lo, hi = first[r], first[r + 1]
            if hi - lo >= k:
                yield a + r, np.unique(wins[lo : hi - k + 1])
            elif hi > lo:
                yield a + r, mix(window_hashes(words[lo:hi], int(hi - lo), BASES[0]) + np.uint64(hi - lo))
            else:
                yield a + r, np.zeros(0, np.uint64)

_letter: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters, as str.isalpha has it."""
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letter


def letter_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points of the texts, starts and ends of their runs of letters, and each text's first run (with the end)."""
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[code]
    edge = np.diff(np.concatenate([[False], is_letter, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offs = np.concatenate([[0], np.cumsum([len(t) + 1 for t in low])])
    return code, starts, ends, np.searchsorted(starts, offs)


def run_hashes(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of code points; long runs wrap round the position table."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    spans = ends - starts
    total = np.cumsum(spans)
    place = np.arange(total[-1]) - np.repeat(total - spans, spans)
    at = place + np.repeat(starts, spans)
    part = mix(code[at].astype(np.uint64) + np.uint64(0x1000)) * _PLACE[place & (LONG_WORD - 1)]
    return mix(np.add.reduceat(part, total - spans) + spans.astype(np.uint64))


def row_slices(batch: pa.RecordBatch, text_at: int, chars: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `chars` bytes of text (one longer text is a slice of its own)."""
    for a, b, _, _ in text_chunks(batch.column(text_at), chars):
        yield batch.slice(a, b - a)
