"""Problem 7: encoding the whole corpus with a public byte-level BPE tokenizer.

Method: a minimal acyclic transducer as lexicon. Frequent words are compiled, with their ids as output, into an automaton
with shared suffixes, in one file that Spark hands to every executor and its workers map read-only, so that they share its
pages; words that aren't in it are merged exactly, by rank.

* A text is split by the tokenizer's pattern, and its words at every place that no token of the vocabulary can bridge:
  two bytes that stand side by side in no token are never merged, so that the ids of a word are those of its parts.
  In Chinese these are nearly all places between two characters, so that a lexicon of parts covers nearly all text.
* The lexicon is compiled from the most frequent parts of a bounded sample. The result doesn't depend on the sample:
  what is not in the lexicon is merged.
* Each task keeps parts that it has met, up to a bound. Texts are encoded whole, however long.

One row per document; null and empty texts have an empty list. Names of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import mmap
import os
import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, shared_dir

TOKENIZERS = "/opt/tokenizers"
RANKS = "byte_bpe_50k.tiktoken"
# Fixed value: the pattern of the tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SAMPLE_ROWS, SAMPLE_CHARS, LEXICON_WORDS = 2_000, 20_000, 20_000
KEPT = 100_000


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of word: the pair of neighbours with the lowest rank is merged, the leftmost first, until none is left."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))  # of the part that begins at i
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def push(i: int) -> None:
        j = right[i]
        if j >= 0 and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = right[i] if alive[i] else -1
        if j < 0 or end[j] != stop:
            continue
        end[i], alive[j], right[i] = stop, False, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        push(i)
        if left[i] >= 0:
            push(left[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def part_pattern(ranks: dict[bytes, int]) -> re.Pattern:
    """Matches the parts of a word: it may only end before a byte that no token has after the byte before.

    It knows ASCII and the ideographs U+4E00 to U+9FFF; between other characters it never ends a part."""
    bridged = np.zeros((256, 256), bool)
    for token in ranks:
        for a, b in zip(token, token[1:]):
            bridged[a, b] = True

    def ideographs(last: set[int]) -> str:
        return "".join(chr(cp) for cp in range(0x4E00, 0xA000) if (cp & 63 | 128) in last)

    ascii_ = lambda cs: "".join(re.escape(chr(c)) for c in cs)
    glue, some = [r"[^一-鿿](?=[^一-鿿])", r"[一-鿿](?=[^\x00-\x7f一-鿿])"], set()
    for lead in range(0xE4, 0xEA):
        low, high = max(0x4E00, (lead - 0xE0) << 12), ((lead - 0xE0) << 12) + 0xFFF
        last = {x for x in range(128, 192) if bridged[x, lead]}
        some |= last
        before = ideographs(last) + ascii_(c for c in range(128) if bridged[c, lead]) + r"\x80-䷿ꀀ-\U0010ffff"
        glue.append(f"[{before}](?=[{chr(low)}-{chr(high)}])")
    to_ascii = {x for x in range(128, 192) if bridged[x, :128].any()}
    if to_ascii:
        glue.append(f"[{ideographs(to_ascii)}](?=[\\x00-\\x7f])")
    # Most ideographs end a part whatever follows, unless that is neither ASCII nor an ideograph.
    plain = ideographs(set(range(128, 192)) - some - to_ascii)
    return re.compile(f"(?s)[{plain}](?![^\\x00-\\x7f一-鿿])|(?:{'|'.join(glue)})*.")


class Lexicon:
    """A minimal acyclic transducer: from word bytes to ids, over flat arrays that can be memory-mapped.

    States are numbered; a state has a slice of edges (label, target, words skipped), so that the walk over a word also
    numbers it among all words in order, and that number finds its ids."""

    MAGIC = 0x4C4558

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        whole = memoryview(self._map).cast("i")
        magic, states, edges, words, ids = whole[:5].tolist()
        if magic != self.MAGIC:
            raise ValueError("no lexicon")
        at = 5
        parts = []
        for n in (states + 1, states, edges, edges, edges, words + 1, ids):
            parts.append(whole[at : at + n])
            at += n
        self.first, self.final, self.label, self.target, self.skip, self.begin, self.ids = parts
        self.root = states - 1  # made last

    def get(self, word: bytes) -> list[int] | None:
        state, number = self.root, 0
        first, label = self.first, self.label
        for byte in word:
            e = bisect_left(label, byte, first[state], first[state + 1])
            if e == first[state + 1] or label[e] != byte:
                return None
            number += self.skip[e]
            state = self.target[e]
        return self.ids[self.begin[number] : self.begin[number + 1]].tolist() if self.final[state] else None


def compile_lexicon(words: Iterable[bytes], ranks: dict[bytes, int]) -> bytes:
    """The bytes of a Lexicon of the words."""
    words = sorted(set(words))
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # final, ((label, target), ...)
    counts: list[int] = []

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
            counts.append(node[0] + sum(counts[t] for _, t in node[1]))
        return register[key]

    path: list[list] = [[False, []]]  # the nodes of the last word, not yet shared
    last = b""
    for word in words:
        same = len(os.path.commonprefix([last, word]))
        while len(path) > same + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], freeze(node)))
    states.append((path[0][0], tuple(path[0][1])))  # the root is never shared
    counts.append(0)

    first, final, label, target, skip = [0], [], [], [], []
    for is_final, edges in states:
        before = int(is_final)
        final.append(int(is_final))
        for byte, to in edges:
            label.append(byte)
            target.append(to)
            skip.append(before)
            before += counts[to]
        first.append(len(label))
    ids = [merge(w, ranks) if w else [] for w in words]
    begin = np.concatenate([[0], np.cumsum([len(x) for x in ids])]) if ids else [0]
    flat = [i for x in ids for i in x]
    head = [Lexicon.MAGIC, len(states), len(label), len(words), len(flat)]
    return np.concatenate([np.asarray(x, np.int32) for x in (head, first, final, label, target, skip, begin, flat)]).tobytes()


class _Parts(dict):
    """Packed ids by part of a word."""

    def __init__(self, ranks: dict[bytes, int], lexicon: Lexicon | None) -> None:
        self.ranks, self.lexicon = ranks, lexicon

    def __missing__(self, part: str) -> bytes:
        raw = part.encode("utf-8", "replace")
        ids = self.lexicon.get(raw) if self.lexicon else None
        if ids is None:
            ids = merge(raw, self.ranks)
        out = pack(f"<{len(ids)}i", *ids)
        if len(self) < KEPT and len(part) < 64:
            self[part] = out
        return out


class Encoder(dict):
    """Packed ids by word; encode() gives those of a text."""

    def __init__(self, ranks: dict[bytes, int], lexicon: Lexicon | None = None) -> None:
        self.parts = _Parts(ranks, lexicon)
        self.split_part = part_pattern(ranks).findall
        self.split_word = regex.compile(PATTERN).findall

    def __missing__(self, word: str) -> bytes:
        out = b"".join(map(self.parts.__getitem__, self.split_part(word)))
        if len(word) < 8 and len(self) < KEPT:
            self[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids of text, as packed 32-bit numbers."""
        return b"".join(map(self.__getitem__, self.split_word(text)))


@lru_cache(maxsize=2)
def _encoder(ranks_path: str, lexicon: str | None) -> Encoder:
    return Encoder(load_ranks(ranks_path), Lexicon(lexicon) if lexicon else None)


def build_lexicon(documents: DataFrame, text_col: str, ranks_path: str, sample_rows: int = SAMPLE_ROWS, words: int = LEXICON_WORDS) -> bytes:
    """The lexicon of the most frequent parts of at most sample_rows texts of up to SAMPLE_CHARS characters.

    take reads only as many partitions as it needs, and shuffles nothing."""
    encoder = _encoder(ranks_path, None)
    counts: Counter[str] = Counter()
    for (text,) in documents.select(text_col).where(F.length(text_col).between(1, SAMPLE_CHARS)).take(sample_rows):
        for word in encoder.split_word(text):
            counts.update(encoder.split_part(word))
    return compile_lexicon((w.encode("utf-8", "replace") for w, _ in counts.most_common(words)), load_ranks(ranks_path))


def ship(spark: SparkSession, data: bytes) -> str:
    """Write data as a file of the shared folder and have Spark hand it to every executor; its name, unique to this run."""
    name = f"p7-lexicon-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def encode(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizers: str = TOKENIZERS, slice_chars: int = 400_000) -> DataFrame:
    """id_col and ids of every row of documents."""
    ranks_path = os.path.join(tokenizers, RANKS)
    lexicon = ship(documents.sparkSession, build_lexicon(documents, text_col, ranks_path))  # LEXICON_WORDS words

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, SparkFiles.get(lexicon))
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            start, sizes, packed = 0, [0], []

            def out(stop: int) -> pa.RecordBatch:
                values = pa.Array.from_buffers(pa.int32(), sum(sizes) // 4, [None, pa.py_buffer(b"".join(packed))])
                offsets = pa.array(np.cumsum(np.asarray(sizes, np.int64) // 4).astype(np.int32))
                return pa.RecordBatch.from_arrays([keys.slice(start, stop - start), pa.ListArray.from_arrays(offsets, values)], names=[id_col, "ids"])

            chars = 0
            for i, text in enumerate(texts):
                text = text.as_py() or ""
                packed.append(encoder.encode(text))
                sizes.append(len(packed[-1]))
                chars += len(text)
                if chars >= slice_chars:
                    yield out(i + 1)
                    start, sizes, packed, chars = i + 1, [0], [], 0
            if packed:
                yield out(len(texts))

    return documents.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).mapInArrow(encode_batches, f"{id_col} long, ids array<int>")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and ids of every document."""
    return encode(read(spark, sf_dir, "documents"))
