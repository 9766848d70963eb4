"""Byte-level BPE encoding and decoding with recursive SQL inside each partition.

A task cuts its texts into words (the matches of the tokenizer's pattern), keeps the distinct ones, and lets
an in-process DuckDB encode each distinct word once: its byte tokens are rows by position, neighbouring rows
join the merge table, the leftmost pair of minimum rank is contracted, and the recursion repeats until no
word has a pair left. Ids of a document follow from its words. Decoding goes back the same way: the id
sequences of the distinct words join the vocabulary and an ordered aggregation puts their bytes together.

Words are cut by code-point classes on arrays; the result equals matching
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` from left to right.

Memory: texts are taken in runs of ``RUN`` characters (a longer text is a run of its own), a worker keeps two
generations of up to ``KEPT`` encoded words (when the younger is full the older goes, and words met again move up, so
common words stay), and words go to DuckDB in blocks of ``BLOCK`` bytes, so nothing grows with the partition. The recursion keeps one state per word (not one per round). A single word of n bytes takes n rounds
over n positions at worst. A worker process keeps its merge table and words for the tasks that follow, and frees
them ``IDLE`` seconds after the last one.

Defined results: a null text counts as empty and has no tokens; repeated rows give repeated rows; an empty
table gives an empty result. The vocabulary file is a parameter; it is read on the driver and shipped to the
tasks (its size is fixed by the tokenizer, about half a megabyte).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from threading import Timer

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 1 << 20
BLOCK = 1 << 18
KEPT = 1 << 19
IDLE = 2.0

# The pattern whose matches are encoded one by one.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@cache
def classes() -> np.ndarray:
    """The pattern's class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(name, every):
            low, high = m.span()
            for a, b in ((low, min(high, 0xD800)), (max(low, 0xD800), high)):
                if a < b:
                    shift = 0x800 if a >= 0xD800 else 0
                    out[a + shift : b + shift] = kind
    return out


def word_starts(points: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin in joined texts; ``texts`` has the offset of each text."""
    n = points.size
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    first[texts[texts < n]] = True
    first[n] = True
    cut = first[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(cut)
    ends = np.append(runs[1:], n)
    starts = cut.copy()
    spaces = kind[runs] == SPACE
    # a run of spaces gives its last one to what follows: a blank joins it, another space stands alone
    follows = spaces & ~first[ends]
    last = ends - 1
    starts[last[follows]] = True
    joins = follows & (points[last] == 32)
    starts[ends[joins]] = False
    # contractions: an apostrophe that opens a match and is all of its run, then the letters of a short form
    nexts = np.flatnonzero((points == 39) & starts)
    nexts = nexts[nexts + 1 < n]
    for tail in ("s", "t", "re", "ve", "m", "ll", "d"):
        if not nexts.size:
            break
        size = len(tail)
        fits = nexts + size < n
        for k, c in enumerate(tail):
            at = np.minimum(nexts + 1 + k, n - 1)
            fits &= (points[at] == ord(c)) & ~first[at]
        hit = nexts[fits]
        starts[hit + 1] = False
        after = hit + 1 + size
        after = after[after < n]
        starts[after] = True
        nexts = nexts[~fits]
    return np.flatnonzero(starts)


# Each round contracts the leftmost pair of minimum rank of every word.
FIRST_PLACE = """
WITH RECURSIVE state(w, l) USING KEY (w) AS (
  SELECT w, l FROM word
  UNION
  SELECT s.w, s.l[:best.i - 1] || [best.r::INTEGER] || s.l[best.i + 2:]
  FROM (
    SELECT w, min((m.r << 32) | i) AS c, c >> 32 AS r, c & 4294967295 AS i
    FROM (SELECT w, unnest(l[:len(l) - 1]) AS a, unnest(l[2:]) AS b, unnest(range(1, len(l))) AS i FROM state WHERE len(l) > 1) AS position
    JOIN merges m ON m.pair = ((position.a::BIGINT << 32) | position.b)
    GROUP BY w
  ) best JOIN state s ON s.w = best.w
)
SELECT w, l FROM state ORDER BY w
"""


class Coder:
    """One task's DuckDB with the merge table and the vocabulary, and the words encoded so far."""

    def __init__(self, ranks: dict[bytes, int]):
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.con.execute("SET preserve_insertion_order = false")
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        merges = pa.table({"a": pa.array(left, pa.int32()), "b": pa.array(right, pa.int32()), "r": pa.array(rank, pa.int64())})
        vocabulary = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in ranks])})
        self._load("merges", merges, "SELECT (a::BIGINT << 32) | b AS pair, r FROM given")
        self._load("vocabulary", vocabulary, "SELECT * FROM given")
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[bytes, bytes] = {}
        self.decoded: dict[bytes, bytes] = {}  # of ids that decode to something else than their word
        self.older: tuple[dict[bytes, bytes], dict[bytes, bytes]] = {}, {}

    def _load(self, name: str, rows: pa.Table, sql: str) -> None:
        self.con.register("given", rows)
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS {sql}")
        self.con.unregister("given")

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, by contraction until fixpoint."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(w) for w in words], np.int64)
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.of_byte[raw]))
        self._load("word", pa.table({"w": pa.array(np.arange(len(words), dtype=np.int32)), "l": tokens}), "SELECT * FROM given")
        done = self.con.sql(FIRST_PLACE).to_arrow_table()
        ids = done.column("l").combine_chunks()
        flat, ends = ids.flatten().to_numpy(), ids.offsets.to_numpy()
        ends = ends - ends[0]
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def decode_words(self, words: list[np.ndarray]) -> list[bytes]:
        """Bytes of each id sequence: positions join the vocabulary, an ordered aggregation joins the bytes."""
        lengths = np.array([w.size for w in words], np.int64)
        flat = np.concatenate(words).astype(np.int32) if words else np.zeros(0, np.int32)
        w = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        at = np.arange(flat.size, dtype=np.int32)
        self._load("ids", pa.table({"w": pa.array(w), "p": pa.array(at), "id": pa.array(flat)}), "SELECT * FROM given")
        out = self.con.execute(
            "SELECT w, string_agg(hex, '' ORDER BY p) AS hex FROM ids JOIN vocabulary USING (id) GROUP BY w ORDER BY w"
        ).fetchall()
        found = {k: bytes.fromhex(v) for k, v in out}
        return [found.get(k, b"") for k in range(len(words))]

    def make_room(self, n: int) -> None:
        """Before ``n`` words come: if the younger generation would outgrow ``KEPT``, it becomes the older one."""
        if len(self.known) + n > KEPT:
            self.older = self.known, self.decoded
            self.known, self.decoded = {}, {}

    def move_up(self, words: list[bytes]) -> None:
        """Words of the older generation that are met again join the younger one, with what they decode to."""
        known, decoded = self.older
        for w in words:
            if w not in self.known and (ids := known.get(w)) is not None:
                self.known[w] = ids
                if ids in decoded:
                    self.decoded[ids] = decoded[ids]

    def learn(self, words: list[bytes]) -> None:
        """Encode and keep the words not known yet."""
        if self.older[0]:
            self.move_up(words)
        new = [w for w in words if w not in self.known]
        direct = [w for w in new if w in self.ranks]
        for w in direct:
            self.known[w] = np.array([self.ranks[w]], np.int32).tobytes()
        rest = [w for w in new if w not in self.ranks]
        block, size = [], 0
        for i, w in enumerate(rest):
            block.append(w)
            size += len(w)
            if size >= BLOCK or i + 1 == len(rest):
                for word, ids in zip(block, self.encode_words(block)):
                    self.known[word] = ids.astype(np.int32).tobytes()
                block, size = [], 0
        self.learn_back(new)

    def learn_back(self, words: list[bytes]) -> None:
        """Decode the ids of new words; only what differs from its word is kept, so a word takes half the memory."""
        for at in range(0, len(words), BLOCK // 8):
            part = words[at : at + BLOCK // 8]
            ids = [self.known[w] for w in part]
            back = self.decode_words([np.frombuffer(i, np.int32) for i in ids])
            self.decoded.update((i, d) for w, i, d in zip(part, ids, back) if d != w)


def split_words(texts: list[str]) -> list[list[bytes]]:
    """The pattern's matches of every text, as bytes."""
    joined = "".join(texts)
    if not joined:
        return [[] for _ in texts]
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    offsets = np.concatenate(([0], ends))
    starts = word_starts(points, offsets)
    # code points to bytes
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    at = np.concatenate(([0], np.cumsum(width)))
    data = joined.encode("utf-8")
    edges = np.append(at[starts], at[-1]).tolist()
    words = [data[a:b] for a, b in zip(edges[:-1], edges[1:])]
    first = np.searchsorted(starts, offsets).tolist()
    return [words[a:b] for a, b in zip(first[:-1], first[1:])]


def runs(texts: list[str]) -> Iterator[list[str]]:
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > RUN:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


_CODERS: dict[str, Coder] = {}
_ENDS: list[Timer] = []


@contextmanager
def coder_of(ranks: dict[bytes, int], digest: str) -> Iterator[Coder]:
    """The worker process's coder for these ranks; tasks of other ranks take its place.

    A worker goes on to other stages' tasks, so ``IDLE`` seconds after the last task the coder is let go.
    """
    while _ENDS:
        _ENDS.pop().cancel()
    coder = _CODERS.get(digest)
    if coder is None:
        _CODERS.clear()
        coder = _CODERS[digest] = Coder(ranks)
    try:
        yield coder
    finally:
        end = Timer(IDLE, _CODERS.clear)
        end.daemon = True
        _ENDS.append(end)
        end.start()


def encode_run(coder: Coder, texts: list[str]) -> list[tuple[bytes, bytes]]:
    """Per text of a run: its ids as little-endian 32-bit integers, and the bytes they decode to."""
    words = split_words(texts)
    distinct = set().union(*words)
    coder.make_room(len(distinct))
    coder.learn(list(distinct))
    out = []
    for own in words:
        ids = list(map(coder.known.__getitem__, own))
        out.append((b"".join(ids), b"".join(map(coder.decoded.get, ids, own))))
    return out


def coding_task(ranks: dict[bytes, int], with_values: bool):
    """Rows (keys..., text) to keys, n_tokens, digests of ids and decoded bytes, and the values when asked for."""

    digest = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with coder_of(ranks, digest) as coder:
            yield from coded(coder, batches)

    def coded(coder: Coder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                n, ids_hash, text_hash, ids_out, text_out = [], [], [], [], []
                for chunk in runs(texts):
                    for ids, decoded in encode_run(coder, chunk):
                        n.append(len(ids) // 4)
                        ids_hash.append(hashlib.sha256(ids).hexdigest())
                        text_hash.append(hashlib.sha256(decoded).hexdigest())
                        if with_values:
                            ids_out.append(np.frombuffer(ids, np.int32))
                            text_out.append(decoded.decode("utf-8"))
                columns = [part.column(k) for k in range(part.num_columns - 1)]
                names = [*batch.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"]
                columns += [pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                if with_values:
                    columns += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(text_out, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(
    docs: DataFrame, ranks_path: str, keys: dict[str, Column], text_col: str = "text", with_values: bool = True
) -> DataFrame:
    """The key columns of every row with n_tokens, ids_sha256, decoded_sha256 and, when asked, ids and decoded."""
    rows = docs.select(*[c.alias(k) for k, c in keys.items()], F.col(text_col).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    values = ", ids array<int>, decoded string" if with_values else ""
    return rows.mapInArrow(
        coding_task(read_ranks(ranks_path), with_values),
        f"{fields}, n_tokens long, ids_sha256 string, decoded_sha256 string{values}",
    )


def report(docs: DataFrame, ranks_path: str) -> DataFrame:
    return encode(docs, ranks_path, {"doc_id": F.col("doc_id")}, with_values=False)
