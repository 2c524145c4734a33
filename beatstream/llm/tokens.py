"""Token-id output: frequency-ranked ids in byte-aligned variable-length coding.

A corpus is tokenised once, token ids are counted over all of it and replaced by their
frequency rank, and the ranks of consecutive documents are packed in blocks.  A rank
takes one to four bytes; the lengths stand apart in control bytes (two bits a value,
four values a byte), so a reader finds all offsets by one table lookup and one sum.

Files: ``<path>/blocks`` (Parquet, one row a block: shard, block, first token within the
shard, ids and lengths of its documents, number of values, control bytes, data bytes) and
``<path>/ranks`` (rank, token id, count).  Shards hold consecutive ranges of the order,
written by Spark's committer, so a lost or repeated task leaves no half-written shard.

Null and empty texts give one document with the end id only; texts of any
length are encoded whole.  Documents with equal order
keys (repeated rows) follow each other in the order of their ids' bytes.  Rows with a null
order key come first.  An empty table gives files without rows.  Extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatstream.llm.common import written

WIDTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = values.astype("<u4")
    extra = ((v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)).astype(np.uint8)
    four = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    four[:len(v)] = extra
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    at = np.cumsum(extra + 1, dtype=np.int64) - extra - 1
    data = np.empty(int(at[-1]) + int(extra[-1]) + 1 if len(v) else 0, np.uint8)
    data[at] = v.astype(np.uint8)
    for k in range(1, 4):
        longer = np.nonzero(extra >= k)[0]
        data[at[longer] + k] = (v[longer] >> np.uint32(8 * k)).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of ``pack``: lengths by table lookup, values by masked four-byte reads."""
    width = WIDTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(width, dtype=np.int64)
    padded = data + b"\0\0\0"
    words = np.ndarray((len(data),), "<u4", padded, strides=(1,))
    return words[ends - width] & MASKS[width]


class Encoder:
    """Ids of texts, by way of their distinct words.

    The tokenizer drops white space and never joins characters across it, so the ids of a
    text are those of its white-space-separated pieces in turn.  A piece that is a word with
    closing marks is two pre-tokens.  Pieces are made distinct, split and put together again
    column-wise; words are encoded many at a time (each is one pre-token, whose last token
    carries the end-of-word mark) and remembered in two generations of about ``limit`` words.
    """

    limit = 300_000
    LONGEST = 40
    SUFFIX = "</w>"
    MARKS = ".,;:!?|&%$#*"
    # Latin letters: one word, whatever normalisation does to them
    PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+[.,;:!?|&%$#*]*$"
    made: dict[tuple[str, str], Encoder] = {}

    def __init__(self, path: str, dtype: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer, self.dtype = Tokenizer.from_file(path), np.dtype(dtype)
        # the same model for words that need neither normalising nor splitting (a-z only)
        self.words = Tokenizer.from_file(path)
        self.words.normalizer, self.words.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith(self.SUFFIX)]] = True

    @classmethod
    def of(cls, path: str, dtype: str, limit: int = limit) -> Encoder:
        """The worker's encoder; it stays for the next task."""
        if (path, dtype) not in cls.made:
            cls.made[path, dtype] = cls(path, dtype)
        cls.made[path, dtype].limit = limit
        return cls.made[path, dtype]

    def _one(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, self.dtype).tobytes()

    def _many(self, words: list[str], tokenizer) -> list[bytes]:
        """Ids of words that are one pre-token each."""
        if not words:
            return []
        rows = tokenizer.encode_batch_fast([" ".join(words[i:i + 200]) for i in range(0, len(words), 200)],
                                           add_special_tokens=False)
        ids = np.concatenate([np.array(r.ids, self.dtype) for r in rows])
        ends = np.nonzero(self.last[ids])[0] + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return [self._one(w) for w in words]
        raw, cuts = ids.tobytes(), [0, *(ends * self.dtype.itemsize).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def distinct(self, keys: list[str], plain: np.ndarray) -> list[bytes]:
        """Ids of each of the distinct ``keys``: lower-case words where ``plain``, whole pieces elsewhere."""
        out = list(map(self.young.get, keys))
        ascii_words, latin = [], []
        for i in [i for i, x in enumerate(out) if x is None]:
            k = keys[i]
            x = self.old.get(k)
            if x is not None:
                self.young[k] = out[i] = x
            elif not plain[i]:
                self.young[k] = out[i] = self._one(k) if k else b""
            else:
                (ascii_words if k.isascii() else latin).append(i)
        for places, tokenizer in ((ascii_words, self.words), (latin, self.tokenizer)):
            words = [keys[i] for i in places]
            for i, k, x in zip(places, words, self._many(words, tokenizer), strict=True):
                self.young[k] = out[i] = x
        if len(self.young) > self.limit:
            self.young, self.old = {}, {k: x for k, x in self.young.items() if len(k) <= self.LONGEST}
        return out

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as bytes."""
        column = pc.replace_substring(pa.array([t or "" for t in texts], pa.large_string()), "\n", " ")
        split = pc.split_pattern(column, " ")
        coded = split.values.dictionary_encode()
        piece = coded.dictionary
        plain = pc.match_substring_regex(piece, self.PLAIN)
        core = pc.utf8_rtrim(piece, self.MARKS)
        key = pc.if_else(plain, pc.ascii_lower(core), piece).dictionary_encode()
        key_of = key.indices.to_numpy()
        is_plain = plain.to_numpy(zero_copy_only=False)
        key_plain = np.zeros(len(key.dictionary), bool)
        key_plain[key_of[is_plain]] = True
        # a lower-case word may also stand as a whole piece: its ids are the same
        units = self.distinct(key.dictionary.to_pylist(), key_plain)
        # closing marks are units of their own, after the one without ids; most are one byte
        cut = (pc.binary_length(piece).to_numpy() - pc.binary_length(core).to_numpy()) * is_plain
        tail = np.full(len(piece), len(units))
        units.append(b"")
        ends = np.frombuffer(piece.buffers()[1], np.int64)[piece.offset:piece.offset + len(piece) + 1]
        last = np.frombuffer(piece.buffers()[2], np.uint8)
        one = np.nonzero(cut == 1)[0]
        marks = last[ends[one + 1] - 1]
        for m in np.unique(marks).tolist():
            tail[one[marks == m]] = len(units)
            units.append(self._one(chr(m)))
        more = np.nonzero(cut > 1)[0]
        seen: dict[str, int] = {}
        for i, p, k in zip(more.tolist(), piece.take(pa.array(more)).to_pylist(), cut[more].tolist(), strict=True):
            t = p[-k:]
            if t not in seen:
                seen[t] = len(units)
                units.append(self._one(t))
            tail[i] = seen[t]
        size = np.fromiter(map(len, units), np.int64, len(units)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(units), self.dtype)
        first = np.cumsum(size) - size
        word = coded.indices.to_numpy()
        unit = np.empty(2 * len(word), np.int64)
        unit[0::2], unit[1::2] = key_of[word], tail[word]
        n = size[unit]
        ends = np.cumsum(n)
        ids = flat[np.repeat(first[unit] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate(([0], ends))[2 * split.offsets.to_numpy()]
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]


def _slices(texts: pa.Array, chars: int) -> Iterator[list[str | None]]:
    """Consecutive texts, about ``chars`` characters at a time."""
    part, size = [], 0
    for x in texts:
        t = x.as_py()
        part.append(t)
        size += len(t or "")
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int, dtype: str, order_by: list[str],
             remember: int, slice_chars: int) -> DataFrame:
    """Order columns, doc_id and packed little-endian ids of every row, as a written table."""
    keys = [F.col(c).alias(f"key{i}") for i, c in enumerate(order_by)]
    rows = docs.select(*keys, "doc_id", "text")
    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = Encoder.of(tokenizer_path, dtype, remember), np.array([end_id], dtype).tobytes()
        for b in batches:
            texts = b.column(b.num_columns - 1)
            ids = pa.array([x + end for part in _slices(texts, slice_chars) for x in enc.texts(part)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], ids], [*b.schema.names[:-1], "ids"])

    return written(rows.mapInArrow(run, schema), "token-ids")


def rank_table(tokens: DataFrame, dtype: str, vocabulary: int) -> np.ndarray:
    """(id, count) by falling count, then id.  Only one row per vocabulary entry reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            for k in range(0, b.num_rows, 500):
                ids = b"".join(b.column(0).slice(k, 500).to_pylist())
                total += np.bincount(np.frombuffer(ids, dtype), minlength=vocabulary)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    rows = (tokens.select("ids").mapInArrow(run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    total = np.zeros(vocabulary, np.int64)
    for r in rows:
        total[r.id] = r.n
    order = np.lexsort((np.arange(vocabulary), -total))
    return np.stack([order, total[order]], 1)


BLOCK_SCHEMA = ("shard int, block int, first_token long, doc_ids array<long>, lengths array<int>, "
                "n long, control binary, data binary")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, order_by: list[str] | None = None,
                 block_tokens: int = 65_536, shard_tokens: int = 32_000_000, remember: int = 300_000,
                 slice_chars: int = 6_000_000) -> None:
    """Encode every text and write the token files to ``path`` in the order of ``order_by``.

    A Python worker remembers about ``2 * remember`` words (some 70 MB per 300,000) and works
    on ``slice_chars`` characters at a time: more of both saves CPU time, less saves memory.
    """
    from tokenizers import Tokenizer
    spark = docs.sparkSession
    order_by = order_by or ["doc_id"]
    vocabulary = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1)
    dtype = "<u2" if vocabulary <= 0x10000 else "<u4"
    tokens = tokenise(docs, tokenizer_path, end_id, dtype, order_by, remember, slice_chars)
    ranked = rank_table(tokens, dtype, vocabulary)
    spark.createDataFrame([(k, int(i), int(n)) for k, (i, n) in enumerate(ranked)], "rank int, id int, n long") \
        .coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.empty(vocabulary, np.uint32)
    rank_of[ranked[:, 0]] = np.arange(vocabulary, dtype=np.uint32)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(ranked[:, 1].sum()) // shard_tokens + 1)
    keys = [f"key{i}" for i in range(len(order_by))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        ids, parts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            control, data = pack(rank_of[np.concatenate(parts)])
            lengths = [len(p) for p in parts]
            cols = [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([size], pa.int64()), pa.array([control], pa.binary()), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in BLOCK_SCHEMA.split(", ")])

        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids.append(d)
                parts.append(np.frombuffer(x.as_buffer(), dtype))
                size += len(parts[-1])
                if size >= block_tokens:
                    yield flush()
                    block, first, ids, parts, size = block + 1, first + size, [], [], 0
        if ids:
            yield flush()

    (tokens.repartitionByRange(shards, *keys).sortWithinPartitions(*keys, "doc_id", "ids").select("doc_id", "ids")
     .mapInArrow(run, BLOCK_SCHEMA).write.parquet(f"{path}/blocks"))


def in_file_order(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """(rows, order): doc_id and text with the place of each row in the files that ``docs`` was read from.

    Files count by the number of the task that wrote them.  Rows that don't come from files are
    taken by ascending doc_id.
    """
    try:
        docs.select("_metadata.row_index").schema  # noqa: B018
    except AnalysisException:
        return docs.select("doc_id", "text"), ["doc_id"]
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
    rows = docs.select("doc_id", "text", F.when(number != "", number).cast("long").alias("part"),
                       F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows, ["part", "file", "row"]


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files; ids are little-endian unsigned 32-bit integers.

    The driver keeps one number per shard file (its first token) and the rank table.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    ranks = spark.read.parquet(f"{path}/ranks").collect()
    id_of = np.zeros(len(ranks), "<u4")
    for r in ranks:
        id_of[r.rank] = r.id
    sums = sorted(map(tuple, blocks.groupBy("shard").agg(F.sum("n").alias("n")).collect()))
    offsets = dict(zip([s for s, _ in sums], np.cumsum([0, *(n for _, n in sums)]).tolist(), strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = id_of[unpack(r["control"], r["data"], r["n"])]
                ends = np.cumsum(r["lengths"])
                starts = ends - r["lengths"]
                base = offsets[r["shard"]] + r["first_token"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(base + starts, pa.int64()),
                     pa.array(r["lengths"], pa.int64()),
                     pa.array([ids[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
