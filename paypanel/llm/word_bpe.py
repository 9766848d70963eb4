"""Byte-level BPE encoding and decoding over a table of distinct words.

``encode`` works in four steps:

1. Spark splits every text into words: the special tokens first, then the pattern's matches between them.
2. A task numbers the words of a bounded run of texts, a block, and writes each text as the sequence of its
   word numbers, and the block's words once, in buckets by block. The texts are not read again and neither they nor
   their numbers move.
3. The blocks' words are exchanged and sorted, so that equal words meet; each distinct word is encoded once by merging
   its best-ranked pairs, and its ids are handed to all its (block, number) places, packed by block.
4. Blocks meet their texts in a co-group: the ids take their pieces, and ids and bytes go back to their positions in
   each text. ``decode`` does the same for ids in a table, by a join on the table id -> piece.

Results equal those of the library that defines the vocabulary file, without added special tokens, unused
truncation and padding; ``<special>`` strings within a text are its special tokens, as they are there.

Skew: a frequent word is one row per block, not one per occurrence. A block holds at most ``BLOCK_CHARS`` code points
(a longer text is a block of its own) and about ``BLOCK_WORDS`` distinct words, so no task holds more than that.

Defined results: a null text counts as empty; an empty text has no tokens; a very long text is encoded whole (a single
word of n bytes costs n log n); repeated rows give repeated rows; equal words have equal ids, so there are no ties except
pairs of one rank, where the left one merges first; an empty table gives an empty result. Only the named key
columns and the text are read, whatever else the table holds.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paypanel.plans.stages import written, written_in_buckets

BLOCK_CHARS = 1 << 26
BLOCK_WORDS = 1 << 20
#: Places of words that a task gathers before it hands them on.
PLACES = 1 << 18

# White space as the pattern counts it, and the pattern. Its last two forms leave the last blank of a run to the next word.
SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
PATTERN = (
    r" ?\p{L}+| ?\p{N}+|'(?:s|t|re|ve|m|ll|d)"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


@dataclass(frozen=True)
class Vocabulary:
    """What a vocabulary file states: ids of single bytes, merges by pair, bytes of every id, special tokens."""

    of_byte: list[int]
    merges: dict[tuple[int, int], tuple[int, int]]
    pieces: dict[int, bytes]
    special: dict[str, int]


def letters_of_bytes() -> list[str]:
    """The letter that stands for each byte in the file: itself if it prints, else the next one from U+0100 on."""
    out, free = [], 0x100
    for b in range(256):
        prints = 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD
        out.append(chr(b if prints else free))
        free += not prints
    return out


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    model = given["model"]
    cutter = given["pre_tokenizer"]
    plain = cutter["type"] == "ByteLevel" and not cutter["add_prefix_space"] and given["normalizer"] is None
    if model["type"] != "BPE" or not plain or model.get("ignore_merges") or model.get("dropout"):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in given["added_tokens"]):
        raise ValueError("special tokens that take in their surroundings are not supported")
    letters = letters_of_bytes()
    byte_of = {c: b for b, c in enumerate(letters)}
    ids = model["vocab"]
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges[ids[a], ids[b]] = rank, ids[a + b]
    special = {t["content"]: t["id"] for t in given["added_tokens"]}
    pieces = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
    pieces |= {i: token.encode() for token, i in special.items()}
    return Vocabulary([ids[c] for c in letters], merges, pieces, special)


def merge(ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge the pair of least rank, the leftmost of equal ones, until no pair is in the table."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(*merges[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
    heapq.heapify(queue)
    while queue:
        _, new, i = heapq.heappop(queue)
        j = after[i]
        if ids[i] < 0 or j >= n or merges.get((ids[i], ids[j]), (0, -1))[1] != new:
            continue  # one of the two has been merged since
        ids[i], ids[j] = new, -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (m := merges.get((new, ids[k]))) is not None:
                heapq.heappush(queue, (*m, i))
        if (h := before[i]) >= 0 and (m := merges.get((ids[h], new))) is not None:
            heapq.heappush(queue, (*m, h))
    return [x for x in ids if x >= 0]


def words_of(text: Column, special: dict[str, int]) -> Column:
    """The words of a text in order, special tokens among them."""

    def matches(segment: Column) -> Column:
        return F.regexp_extract_all(segment, F.lit(PATTERN), F.lit(0))

    if not special:
        return matches(text)
    tokens = "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True))
    hits = F.regexp_extract_all(text, F.lit(f"({tokens})"), F.lit(0))
    between = F.transform(
        F.split(text, tokens, -1),
        lambda s, i: F.concat(matches(s), F.when(i < F.size(hits), F.array(F.get(hits, i))).otherwise(F.array())),
    )
    return F.when(text.rlike(tokens), F.flatten(between)).otherwise(matches(text))


def packed(numbers: np.ndarray) -> bytes:
    """Word numbers as compressed byte planes; the high planes are mostly zero."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True) if planes else b""


def unpacked(blob: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(blob, 4 * n, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<u4").ravel()


def numbering_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (keys..., words) to (keys..., block, n_words, places, words): a row per text, and one per block with its words."""
    task = TaskContext.get().partitionId()
    block, chars, known = 0, 0, {}

    def dictionary(like: pa.RecordBatch) -> pa.RecordBatch:
        keys = [pa.nulls(1, f.type) for f in list(like.schema)[:-1]]
        own = [pa.array([(task << 32) + block]), pa.array([0]), pa.nulls(1, pa.binary())]
        words = pa.array([list(known)], pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([*keys, *own, words], names=[*like.schema.names[:-1], "block", "n_words", "places", "words"])

    batch = None
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            # the next texts that fit into the block, one at least
            lists = batch.column(batch.num_columns - 1)
            ends = lists.offsets.to_numpy()
            flat = lists.values.slice(ends[at], ends[-1] - ends[at])
            spans = np.zeros(1, np.int32)
            if len(flat):
                spans = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
            sizes = spans[ends[at:] - ends[at]] - spans[0]
            take = max(1, int(np.searchsorted(sizes, BLOCK_CHARS - chars, "right")) - 1) if len(flat) else batch.num_rows - at
            flat = flat.slice(0, ends[at + take] - ends[at])
            coded = flat.dictionary_encode()
            numbers = np.array([known.setdefault(w, len(known)) for w in coded.dictionary.to_pylist()], np.int64)
            places = numbers[coded.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64)
            cuts = ends[at : at + take + 1] - ends[at]
            part = batch.slice(at, take)
            columns = [part.column(k) for k in range(part.num_columns - 1)]
            columns += [
                pa.array(np.full(take, (task << 32) + block, np.int64)),
                pa.array(np.diff(cuts).astype(np.int64)),
                pa.array([packed(places[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                pa.nulls(take, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "block", "n_words", "places", "words"])
            chars += int(sizes[take])
            at += take
            if chars >= BLOCK_CHARS or len(known) >= BLOCK_WORDS or at < batch.num_rows:
                yield dictionary(batch)
                block, chars, known = block + 1, 0, {}
    if batch is not None and known:
        yield dictionary(batch)


def merging_task(vocabulary: Vocabulary):
    """Sorted rows (word, block, number) to rows (block, numbers, sizes, ids): the places of a block's words, packed, with their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_byte, merges, special = vocabulary.of_byte, vocabulary.merges, vocabulary.special
        last: dict[str, np.ndarray] = {}  # a word may go on in the next batch
        held: list[tuple[np.ndarray, ...]] = []

        def coded(word: str) -> np.ndarray:
            if word not in last:
                ids = [special[word]] if word in special else merge([of_byte[b] for b in word.encode()], merges)
                last.clear()
                last[word] = np.array(ids, np.uint32)
            return last[word]

        def gathered() -> pa.RecordBatch:
            block, number, size, ids = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order = np.lexsort((number, block))
            flat = _spans(np.cumsum(size) - size, size, order)
            block, number, size, ids = block[order], number[order], size[order], ids[flat]
            cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            ends = np.append(cuts[1:], block.size)
            last_id = np.append(0, np.cumsum(size))
            rows = [
                (int(block[a]), b - a, last_id[b] - last_id[a], packed(np.diff(number[a:b], prepend=0)), packed(size[a:b]), packed(ids[last_id[a] : last_id[b]]))
                for a, b in zip(cuts, ends)
            ]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["block", "n", "n_ids", "numbers", "sizes", "ids"])

        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(0).dictionary_encode()
            lists = [coded(w) for w in words.dictionary.to_pylist()]
            lengths = np.array([x.size for x in lists], np.int64)
            which = words.indices.to_numpy()
            flat = np.concatenate(lists)[_spans(np.cumsum(lengths) - lengths, lengths, which)]
            held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64), lengths[which], flat))
            if sum(h[0].size for h in held) >= PLACES:
                yield gathered()
        if held:
            yield gathered()

    return run


def _spans(starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Positions of the chosen spans' elements, one span after the other."""
    count = lengths[which]
    ends = np.cumsum(count)
    return np.repeat(starts[which] - ends + count, count) + np.arange(int(ends[-1]) if ends.size else 0)


def pieces_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """A row per id: its bytes in hexadecimal digits. Its size is fixed by the vocabulary."""
    rows = pa.table({"id": pa.array(list(vocabulary.pieces), pa.int32()), "piece": [p.hex() for p in vocabulary.pieces.values()]})
    return spark.createDataFrame(rows)


def decode(coded: DataFrame, vocabulary: Vocabulary, key: str, ids: str = "ids") -> DataFrame:
    """(key, ids, decoded bytes) of rows with a unique key: ids join their pieces, which are put together by position.

    Ids that the vocabulary does not have are left out, as the library does. Rows without ids are left out.
    """
    placed = coded.select(key, F.posexplode(ids).alias("at", "id"))
    joined = placed.join(F.broadcast(pieces_table(coded.sparkSession, vocabulary)), "id")
    whole = joined.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "id", "piece"))).alias("row"))
    pieces = F.transform("row", lambda x: x.piece)
    return whole.select(
        key, F.transform("row", lambda x: x.id).alias("ids"), F.unhex(F.array_join(pieces, "")).alias("decoded")
    )


def joined(values: pa.BinaryArray) -> bytes:
    """All values of an array one after the other."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    return data[ends[0] : ends[-1]].to_pybytes() if data is not None and len(values) else b""


def placing_task(vocabulary: Vocabulary, n_keys: int, with_values: bool):
    """A block's texts and encoded words to ids and bytes of every text."""
    pieces = pa.array([vocabulary.pieces.get(i, b"") for i in range(max(vocabulary.pieces, default=-1) + 1)], pa.binary())

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        numbers, lengths, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for row in words.select(["n", "n_ids", "numbers", "sizes", "ids"]).to_pylist():
            numbers.append(np.cumsum(unpacked(row["numbers"], row["n"]).astype(np.int64)))
            lengths.append(unpacked(row["sizes"], row["n"]).astype(np.int64))
            flat.append(unpacked(row["ids"], row["n_ids"]))
        number, length = np.concatenate(numbers), np.concatenate(lengths)
        order = np.argsort(number)
        flat = np.concatenate(flat)[_spans(np.cumsum(length) - length, length, order)]
        length = length[order]
        starts = np.cumsum(length) - length
        # a word's bytes are those of its ids, so the ends of its last ids cut the joined pieces into words
        parts = pieces.take(pa.array(flat))
        ends = np.frombuffer(parts.buffers()[1], np.int32)[: flat.size + 1] if flat.size else np.zeros(1, np.int32)
        cuts = pa.py_buffer(np.ascontiguousarray(ends[np.append(starts, flat.size)], np.int32))
        plain_words = pa.Array.from_buffers(pa.binary(), length.size, [None, cuts, parts.buffers()[2] if flat.size else pa.py_buffer(b"")])
        n, ids_hash, text_hash, all_ids, all_texts = [], [], [], [], []
        for blob, size in zip(texts.column("places").to_pylist(), texts.column("n_words").to_pylist()):
            at = unpacked(blob, size)
            ids = flat[_spans(starts, length, at)].astype("<u4")
            plain = joined(plain_words.take(pa.array(at)))
            n.append(ids.size)
            ids_hash.append(hashlib.sha256(ids.tobytes()).hexdigest())
            decoded = plain.decode("utf-8", "replace")
            text_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
            if with_values:
                all_ids.append(ids.astype(np.int32))
                all_texts.append(decoded)
        columns = [texts.column(k) for k in range(n_keys)]
        names = [*texts.column_names[:n_keys], "n_tokens", "ids_sha256", "decoded_sha256"]
        columns += [pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
        if with_values:
            columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_texts, pa.string())]
            names += ["ids", "decoded"]
        return pa.Table.from_arrays(columns, names=names)

    return run


def encode(
    docs: DataFrame, vocabulary_path: str, keys: dict[str, Column], text_col: str = "text", with_values: bool = True
) -> DataFrame:
    """The key columns of every row with n_tokens, ids_sha256, decoded_sha256 and, when asked, ids and decoded."""
    vocabulary = read_vocabulary(vocabulary_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*[c.alias(k) for k, c in keys.items()], words_of(text, vocabulary.special).alias("_words"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    own = "block long, n_words long, places binary, words array<string>"
    layer = written_in_buckets(rows.mapInArrow(numbering_task, f"{fields}, {own}"), "block", "word_places")

    entries = layer.where(F.col("words").isNotNull()).select("block", F.posexplode("words").alias("number", "word"))
    met = entries.repartition("word").sortWithinPartitions("word").select("word", "block", "number")
    places = "block long, n long, n_ids long, numbers binary, sizes binary, ids binary"
    placed = written(met.mapInArrow(merging_task(vocabulary), places), "placed-words")

    texts = layer.where(F.col("places").isNotNull()).select(*keys, "block", "n_words", "places")
    values = ", ids array<int>, decoded string" if with_values else ""
    return (
        texts.groupBy("block")
        .cogroup(placed.groupBy("block"))
        .applyInArrow(
            placing_task(vocabulary, len(keys), with_values),
            f"{fields}, n_tokens long, ids_sha256 string, decoded_sha256 string{values}",
        )
    )


def report(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    return encode(docs, vocabulary_path, {"doc_id": F.col("doc_id")}, with_values=False)
