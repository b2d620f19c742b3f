"""Token ids in files compressed by a Re-Pair grammar.

Texts are dealt out by ranges of doc_id and sorted; a task encodes its documents, cuts them into
shards of about `shard_tokens` ids, compresses each shard on its own and writes it as one file. Within a
shard, Re-Pair replaces frequent pairs of neighbouring symbols by new symbols, again and again: a turn
takes the `pairs` most frequent ones that occur `least` times or more, replaces them from left to right and
counts anew only the pairs beside. Turns go on until no pair occurs `least` times; `pairs` bounds a turn, not the grammar. A rule takes
12 bytes of a file and each use of it saves 3, so that pairs seen fewer than four times would not pay.
No pair reaches over the end of a document, so that every document can be decoded alone.

File (little endian): magic, then a header of eight int64: format version, vocabulary size, documents,
symbols, rules, ids, ids before this shard in its partition, partition. Then doc_id int64 (and one byte each: 1 if
null), symbol offset of each document int64 (one more at the end), rule pairs uint32, expansion lengths
of the rules uint32, the symbols' lower 16 bits uint16, and the upper 8 bits uint8. A rule makes symbol
vocabulary + its number, of two earlier symbols.

Defined cases: a null or empty text is the closing id alone; a null doc_id comes last; rows of equal
doc_id are ordered by their texts' hash; an empty table gives no file and an empty result; extra columns are not
looked at. A document longer than a shard has a shard of its own.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.llm import tokens
from sievelake.llm.storage import folder, keep, write_file

MAGIC = b"REPAIR\x00\x01"
SHARD_TOKENS = 1_000_000
PAIRS = 2048
LEAST = 4
END = 1
_WRITTEN = "partition int, file string, docs long, ids long, symbols long"
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long, partition int"


def _sorted(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places and their keys in order of the keys. Both in one word, if they fit, sort several times faster."""
    half = max(int((key & np.uint64(0xFFFFFFFF)).max(initial=0)).bit_length(), 1)
    high = int((key >> np.uint64(32)).max(initial=0)).bit_length()
    place = max(int(at.max(initial=0)).bit_length(), 1)
    if high + half + place > 64:
        order = np.argsort(key, kind="stable")
        return at[order], key[order]
    h, p, low = np.uint64(half), np.uint64(place), np.uint64(0xFFFFFFFF)
    packed = ((((key >> np.uint64(32)) << h) | (key & low)) << p) | at.astype(np.uint64)
    packed.sort()
    pair = packed >> p
    return (packed & np.uint64((1 << place) - 1)).astype(np.int64), ((pair >> h) << np.uint64(32)) | (pair & np.uint64((1 << half) - 1))


class _Pairs:
    """The pairs of neighbouring symbols that may be frequent: key, count of places, and where they were found.

    A pair's places all come about in one turn, that in which the later of its symbols is made; afterwards it only
    becomes rarer. So a pair is numbered once, if it is frequent then, and counts change only beside what a turn replaced.
    """

    def __init__(self, places: int, least: int):
        self.of = np.full(places, -1, np.int32)
        self.least = least
        self.key, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begin, self.size, self.at = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, at: np.ndarray, key: np.ndarray) -> None:
        """Number the pairs of `key` that stand at the places `at`; those seen too rarely are forgotten."""
        at, key = _sorted(at, key)
        opens = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(opens, append=len(key))
        often = size >= self.least
        held = np.repeat(often, size)
        at, opens, size = at[held], opens[often], size[often]
        self.of[at] = np.repeat(np.arange(len(self.key), len(self.key) + len(size), dtype=np.int32), size)
        self.begin = np.concatenate([self.begin, len(self.at) + np.cumsum(size) - size])
        self.at = np.concatenate([self.at, at.astype(np.int32)])
        self.key, self.count, self.size = np.concatenate([self.key, key[opens]]), np.concatenate([self.count, size]), np.concatenate([self.size, size])

    def drop(self, at: np.ndarray) -> None:
        pair = self.of[at]
        self.count -= np.bincount(pair[pair >= 0], minlength=len(self.count))
        self.of[at] = -1

    def most_frequent(self, pairs: int) -> np.ndarray:
        """Numbers of the `pairs` most frequent pairs, of equal counts those of the least keys, in order of their keys."""
        often = np.flatnonzero(self.count >= self.least)
        if len(often) > pairs:
            limit = np.partition(self.count[often], len(often) - pairs)[len(often) - pairs]
            above, equal = often[self.count[often] > limit], often[self.count[often] == limit]
            equal = equal[np.argsort(self.key[equal], kind="stable")][: pairs - len(above)]
            often = np.concatenate([above, equal])
        return often[np.argsort(self.key[often], kind="stable")]

    def places(self, pairs: np.ndarray) -> np.ndarray:
        size = self.size[pairs]
        after = np.cumsum(size)
        at = self.at[np.repeat(self.begin[pairs] - after + size, size) + np.arange(after[-1])]
        return np.sort(at[self.of[at] == np.repeat(pairs, size)])


def compress(ids: np.ndarray, counts: np.ndarray, vocabulary: int, pairs: int = PAIRS, least: int = LEAST):
    """symbols, symbols of each document, rules (n x 2), expansion lengths of the rules."""
    n = len(ids)
    seq = ids.astype(np.uint32)
    last = np.zeros(n, bool)
    last[np.cumsum(counts) - 1] = True
    # neighbours among the symbols that are left
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    stay = np.ones(n, bool)
    rules, lengths = [np.zeros((0, 2), np.uint32)], np.ones(vocabulary, np.uint32)
    known = _Pairs(n, least)

    def keys(at: np.ndarray) -> np.ndarray:
        return (seq[at].astype(np.uint64) << np.uint64(32)) | seq[after[at]]

    open_ = np.flatnonzero(~last)
    known.add(open_, keys(open_))
    while len(chosen := known.most_frequent(pairs)):
        at = known.places(chosen)
        # of overlapping places take every other one, from the left
        opens = np.append(True, after[at[:-1]] != at[1:])
        order = np.arange(len(at))
        at = at[(order - np.maximum.accumulate(np.where(opens, order, 0))) % 2 == 0]
        number = np.full(len(known.key), -1, np.int64)
        used = np.zeros(len(known.key), bool)
        used[known.of[at]] = True
        used = chosen[used[chosen]]
        number[used] = len(lengths) + np.arange(len(used))
        key = known.key[used]
        pair = np.stack([key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
        symbols = number[known.of[at]].astype(np.uint32)
        rules.append(pair)
        lengths = np.concatenate([lengths, lengths[pair].sum(1, dtype=np.uint32)])
        # replace: the right symbol goes, its neighbour is the left one's now
        right = after[at]
        known.drop(right)
        seq[at], last[at], after[at], stay[right] = symbols, last[right], after[right], False
        inner = after[at] < n
        before[after[at[inner]]] = at[inner]
        # pairs that changed: those the new symbols begin, and those they end
        left = before[at]
        left = left[left >= 0]
        beside = np.zeros(n, bool)
        beside[at] = beside[left] = True
        beside = np.flatnonzero(beside)
        known.drop(beside)
        beside = beside[~last[beside]]
        known.add(beside, keys(beside))
    seq, last = seq[stay], last[stay]
    return seq, np.diff(np.flatnonzero(last), prepend=-1), np.concatenate(rules), lengths[vocabulary:]


class Shard:
    """A file's content. `ids(i)` decodes one document, `ids(i, first, count)` a part of it."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a file of this format")
        _, self.vocabulary, docs, symbols, rules, self.total, self.before, self.partition = struct.unpack_from("<8q", data, 8)
        at = 8 + 64

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.doc_id, self.null = take("<i8", docs), take("u1", docs)
        self.offset = take("<i8", docs + 1)
        self.rules = take("<u4", 2 * rules).reshape(-1, 2)
        self.lengths = np.concatenate([np.ones(self.vocabulary, np.int64), take("<u4", rules)])
        low = take("<u2", symbols)
        self.symbols = low.astype(np.uint32) | (take("u1", symbols).astype(np.uint32) << 16)
        # what every symbol stands for, one after the other
        self.begin = np.concatenate([np.arange(self.vocabulary), self.vocabulary + np.cumsum(self.lengths[self.vocabulary :]) - self.lengths[self.vocabulary :]])
        self.flat = np.concatenate([np.arange(self.vocabulary, dtype=np.uint32), np.zeros(int(self.lengths[self.vocabulary :].sum()), np.uint32)])
        newest, i = np.maximum.accumulate(self.rules.max(axis=1, initial=0)), 0
        while i < len(self.rules):  # runs of rules that are made of symbols before the run
            j = max(i + 1, int(np.searchsorted(newest, self.vocabulary + i)))
            made = self.expand(self.rules[i:j].ravel())
            to = self.begin[self.vocabulary + i]
            self.flat[to : to + len(made)] = made
            i = j

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        length = self.lengths[symbols]
        after = np.cumsum(length)
        return self.flat[np.repeat(self.begin[symbols] - after + length, length) + np.arange(after[-1] if len(after) else 0)]

    def ids(self, i: int, first: int = 0, count: int | None = None) -> np.ndarray:
        symbols = self.symbols[self.offset[i] : self.offset[i + 1]]
        after = np.cumsum(self.lengths[symbols])
        total = int(after[-1])
        end = total if count is None else min(total, first + count)
        a, b = np.searchsorted(after, first, "right"), np.searchsorted(after, end, "left") + 1
        skipped = int(after[a - 1]) if a else 0
        return self.expand(symbols[a:b])[first - skipped : end - skipped]


def _parts(doc_ids, counts, ids, vocabulary, before, partition):
    symbols, each, rules, lengths = compress(ids, counts, vocabulary)
    known = [0 if d is None else d for d in doc_ids]
    yield MAGIC + struct.pack("<8q", 1, vocabulary, len(known), len(symbols), len(rules), len(ids), before, partition)
    yield np.array(known, "<i8").tobytes()
    yield np.array([d is None for d in doc_ids], "u1").tobytes()
    yield np.concatenate([[0], np.cumsum(each)]).astype("<i8").tobytes()
    yield rules.astype("<u4").tobytes()
    yield lengths.astype("<u4").tobytes()
    yield (symbols & np.uint32(0xFFFF)).astype("<u2").tobytes()
    yield (symbols >> np.uint32(16)).astype("u1").tobytes()


def writer(target: str, tokenizer: str, by_word: bool, end: int, shard_tokens: int):
    """For mapInArrow: sorted (doc_id, text) to one row per shard written."""

    def rows(batches):
        partition = TaskContext.get().partitionId()
        encoder = tokens.encoder(tokenizer, by_word)
        vocabulary = max(encoder.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        vocabulary = max(vocabulary, end + 1)
        held, size, before, number = [], 0, 0, 0

        def flush():
            nonlocal held, size, before, number
            doc_ids = [d for x in held for d in x[0]]
            counts = np.concatenate([x[1] for x in held])
            ids = np.concatenate([x[2] for x in held])
            file = f"part-{partition:06d}-{number:06d}.repair"
            parts = list(_parts(doc_ids, counts, ids, vocabulary, before, partition))
            write_file(f"{target}/{file}", parts)
            symbols = struct.unpack_from("<8q", parts[0], 8)[3]
            before, number, held, size = before + len(ids), number + 1, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([partition], pa.int32()), pa.array([file]), *[pa.array([n], pa.int64()) for n in (len(doc_ids), len(ids), symbols)]],
                names=["partition", "file", "docs", "ids", "symbols"],
            )

        for batch in batches:
            for first, stop in tokens.steps(batch.column(1)):
                ids, counts = encoder.encode(batch.column(1).slice(first, stop - first), end)
                doc_ids = batch.column(0).slice(first, stop - first).to_pylist()
                ends = np.cumsum(counts)
                begin = 0
                while begin < len(counts):
                    # as many documents as fill the shard, one at least
                    base = ends[begin - 1] if begin else 0
                    upto = int(np.searchsorted(ends, base + max(shard_tokens - size, 0), "right"))
                    upto = max(upto, begin + 1) if not held else max(upto, begin)
                    if upto > begin:
                        held.append((doc_ids[begin:upto], counts[begin:upto], ids[base : ends[upto - 1]].copy()))
                        size += int(ends[upto - 1] - base)
                        begin = upto
                    if begin < len(counts):
                        yield flush()
        if held:
            yield flush()

    return rows


def read_rows(batches):
    """For mapInArrow: file contents to one row per document; `start` is still counted from the partition's begin."""
    for batch in batches:
        for content in batch.column(0):
            shard = Shard(content.as_buffer().to_pybytes())
            out: list[list] = [[], [], [], []]
            at = shard.before
            for first in range(0, len(shard.doc_id), 2000):
                last = min(first + 2000, len(shard.doc_id))
                symbols = shard.symbols[shard.offset[first] : shard.offset[last]]
                ids = shard.expand(symbols).astype("<u4")
                sums = np.concatenate([[0], np.cumsum(shard.lengths[symbols])])
                bounds = sums[shard.offset[first : last + 1] - shard.offset[first]]
                for i, a, b in zip(range(first, last), bounds[:-1], bounds[1:]):
                    out[0].append(None if shard.null[i] else int(shard.doc_id[i]))
                    out[1].append(at)
                    out[2].append(int(b - a))
                    out[3].append(zlib.crc32(ids[a:b].tobytes()))
                    at += int(b - a)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x, pa.int64()) for x in out], pa.array([shard.partition] * len(out[0]), pa.int32())],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "partition"],
            )


def write_tokens(
    docs: DataFrame,
    target: str,
    tokenizer: str,
    by_word: bool = False,
    end: int = END,
    shard_tokens: int = SHARD_TOKENS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write the files; one row per file: partition, file, docs, ids, symbols."""
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = read.repartitionByRange(*order).sortWithinPartitions(*order)
    return keep(dealt.mapInArrow(writer(target, tokenizer, by_word, end, shard_tokens), _WRITTEN))


def read_tokens(spark: SparkSession, target: str, written: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    Starts follow from the sums of the partitions, one row each, that come to the driver.
    """
    sums = {r["partition"]: r["n"] for r in written.groupBy("partition").agg(F.sum("ids").alias("n")).collect()}
    if not sums:
        return spark.createDataFrame([], _READ).drop("partition")
    base, at = [], 0
    for partition in sorted(sums):
        base.append((partition, at))
        at += sums[partition]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.repair").load(target).select("content")
    rows = files.mapInArrow(read_rows, _READ)
    return rows.join(spark.createDataFrame(base, "partition int, base long"), "partition").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer: str, by_word: bool = False, **options) -> DataFrame:
    """Write the ids of `docs` to a new folder of files and read them back."""
    target = folder(docs.sparkSession)
    return read_tokens(docs.sparkSession, target, write_tokens(docs, target, tokenizer, by_word, **options))
