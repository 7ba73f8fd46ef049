"""BPE encoding and decoding by speculation: greedy longest match, then a check of every adjacent pair.

A split of a word into tokens is its BPE encoding exactly if every token encodes to itself
and no two neighbours would have been merged across their border. For each distinct word of a
batch the longest-match split is proposed, all its neighbouring pairs are checked at once
by undoing merges from the latest on, and only words with a failing pair are merged step by step.

The vocabulary is a tokenizer file with lower-casing, word ends and removed white space. The driver
reads it (its path is a parameter); tasks get its tables.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfit.llm.spans import bounds, byte_set
from termfit.llm.words import byte_views, slices

#: Fixed value: the file's rule for cutting normalised text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
#: White space below 128. Nothing composes across it and no word holds it, so texts may be cut there first.
SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
SPACES = re.compile(r"[\x20\x09-\x0D]+")
#: Words up to this many characters are merged in a list, longer ones with a heap.
SHORT = 40
NEVER = 1 << 60
#: Pieces whose encodings a task remembers, and their tokens; beyond either the memory starts afresh.
REMEMBERED = 400_000
REMEMBERED_TOKENS = 4_000_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where visible, else the next free one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in visible else next(free)) for b in range(256)]


class WordBpe:
    """Tables of a word-end BPE vocabulary, and the encoder of single tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end: str = model["end_of_word_suffix"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max(chain(self.vocabulary.values(), self.special.values()))
        self.names = [""] * size
        for name, i in chain(self.vocabulary.items(), self.special.items()):
            self.names[i] = name
        self.made = np.full(size, -1, np.int64)  # rank of the merge that makes a token
        self.left = np.arange(size)
        self.right = np.arange(size)
        self.ranks: dict[tuple[int, int], int] = {}
        pairs, ranks = [], []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair, whole = (self.vocabulary[a], self.vocabulary[b]), self.vocabulary[a + b]
            if pair in self.ranks:
                continue
            self.ranks[pair] = rank
            if self.made[whole] < 0:
                self.made[whole], self.left[whole], self.right[whole] = rank, *pair
            pairs.append(pair[0] * size + pair[1])
            ranks.append(rank)
        order = np.argsort(pairs)
        self.pair_keys, self.pair_ranks = np.array(pairs)[order], np.array(ranks)[order]
        self.inner = {n: i for n, i in self.vocabulary.items() if not n.endswith(self.end)}
        self.final = {n[: -len(self.end)]: i for n, i in self.vocabulary.items() if n.endswith(self.end)}
        self.reach: dict[str, int] = {}  # length of the longest inner token with these two first characters
        for name in self.inner:
            self.reach[name[:2]] = max(len(name), self.reach.get(name[:2], 1))
        self.longest_final = max(map(len, self.final))
        self.alphabet = byte_alphabet()
        self.stable: dict[int, bool] = {}

    def symbols(self, word: str) -> list[int]:
        """The single-character tokens of a word given in the byte alphabet."""
        return [self.inner[c] for c in word[:-1]] + [self.final[word[-1]]]

    def merge(self, tokens: list[int]) -> list[int]:
        """Exact merging: the earliest rule first, at its leftmost place first."""
        if len(tokens) > SHORT:
            return self._merge_long(tokens)
        ranks, tokens = self.ranks.get, list(tokens)
        ranked = [ranks(pair, NEVER) for pair in zip(tokens, tokens[1:], strict=False)]
        while ranked:
            best = min(ranked)
            if best == NEVER:
                break
            at = ranked.index(best)
            tokens[at : at + 2] = [self.vocabulary[self._joined(tokens[at], tokens[at + 1])]]
            del ranked[at]
            if at:
                ranked[at - 1] = ranks((tokens[at - 1], tokens[at]), NEVER)
            if at < len(ranked):
                ranked[at] = ranks((tokens[at], tokens[at + 1]), NEVER)
        return tokens

    def _merge_long(self, tokens: list[int]) -> list[int]:
        """The same with a heap over linked places, O(n log n)."""
        n = len(tokens)
        token: list[int | None] = list(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(ranks[pair], i, *pair) for i, pair in enumerate(zip(tokens, tokens[1:], strict=False)) if pair in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j >= n or token[j] != b:
                continue  # one of the two is part of another token by now
            token[i], token[j] = self.vocabulary[self._joined(a, b)], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                pair = (token[i], token[after[j]])
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], i, *pair))
            if before[i] >= 0:
                pair = (token[before[i]], token[i])
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], before[i], *pair))
        return [t for t in token if t is not None]

    def _joined(self, a: int, b: int) -> str:
        return self.names[a] + self.names[b]

    def is_stable(self, token: int) -> bool:
        """Whether a token's own characters are merged to it."""
        known = self.stable.get(token)
        if known is None:
            name = self.names[token]
            if name.endswith(self.end):
                start = self.symbols(name[: -len(self.end)])
            else:
                start = [self.inner[c] for c in name]
            known = self.stable[token] = self.merge(start) == [token]
        return known

    def propose(self, word: str) -> list[int]:
        """Longest match from the left; the last token carries the word end."""
        tokens, at, n = [], 0, len(word)
        while True:
            whole = self.final.get(word[at:]) if n - at <= self.longest_final else None
            if whole is not None:
                tokens.append(whole)
                return tokens
            for length in range(min(self.reach.get(word[at : at + 2], 1), n - at - 1), 0, -1):
                token = self.inner.get(word[at : at + length])
                if token is not None:
                    tokens.append(token)
                    at += length
                    break
            else:
                raise ValueError(f"the vocabulary has no token for {word[at]!r}")

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE keeps the border between neighbours a and b; all pairs at once.

        The later of the two last merges is undone again and again. The border falls if at some
        point a rule for the two tokens at it comes before the merge undone last: then BPE would have
        used that rule first. Equal rules apply from left to right.
        """
        a, b = a.copy(), b.copy()
        fine = np.ones(len(a), bool)
        # Undoing the left token: a crossing rule must be earlier; the right one: earlier or equal.
        limit = np.full(len(a), 1 << 60)
        open_ = np.arange(len(a))
        size = len(self.names)
        while len(open_):
            x, y = a[open_], b[open_]
            key = x * size + y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[at] == key, self.pair_ranks[at], 1 << 60)
            crossed = rank < limit[open_]
            fine[open_[crossed]] = False
            single = (self.made[x] < 0) & (self.made[y] < 0)
            go = ~crossed & ~single
            open_, x, y = open_[go], x[go], y[go]
            left = self.made[x] > self.made[y]
            limit[open_] = np.where(left, self.made[x], self.made[y] + 1)
            a[open_] = np.where(left, self.right[x], x)
            b[open_] = np.where(left, y, self.left[y])
        return fine

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of words of normalised text."""
        spelled = ["".join([self.alphabet[c] for c in word.encode("utf-8", "replace")]) for word in words]
        split = [self.propose(word) for word in spelled]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        flat = np.fromiter(chain.from_iterable(split), np.int64, int(counts.sum()))
        word = np.repeat(np.arange(len(split)), counts)
        fails = np.zeros(len(split), bool)
        inner = np.flatnonzero(word[1:] == word[:-1])
        if len(inner):
            pairs, back = np.unique(flat[inner] * len(self.names) + flat[inner + 1], return_inverse=True)
            good = self.compatible(pairs // len(self.names), pairs % len(self.names))[back]
            fails[word[inner[~good]]] = True
        tokens = np.unique(flat)
        unstable = tokens[[not self.is_stable(int(t)) for t in tokens]] if len(tokens) else tokens
        if len(unstable):
            fails[word[np.isin(flat, unstable)]] = True
        for i in np.flatnonzero(fails):
            split[i] = self.merge(self.symbols(spelled[i]))
        return split


def normalized(text: str) -> str:
    text = unicodedata.normalize("NFC", text)
    if "Σ" in text:  # each character is lower-cased for itself, so no final sigma arises
        text = text.replace("Σ", "σ")
    return text.lower()


class _Memory:
    """The tokens of the pieces that a task has met. A piece holds no white space; one that begins with a space is a special token."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.pattern = regex.compile(SPLIT)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.tokens = np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def places(self, pieces: list[str]) -> np.ndarray:
        """The places of different pieces; those that are new are cut into words and encoded."""
        if len(self.index) > REMEMBERED or len(self.tokens) > REMEMBERED_TOKENS:
            self.clear()
        fresh = [p for p in pieces if p not in self.index]
        if fresh:
            cuts = [self.pattern.findall(normalized(p)) if p[0] != " " else [p] for p in fresh]
            words = list(dict.fromkeys(chain.from_iterable(cuts)))
            plain = [w for w in words if w[0] != " "]
            made = dict(zip(plain, self.bpe.encode_words(plain), strict=True)) | {w: [self.bpe.special[w[1:]]] for w in words if w[0] == " "}
            split = [list(chain.from_iterable(made[w] for w in cut)) for cut in cuts]
            self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh)), strict=True))
            sizes = np.fromiter(map(len, split), np.int64, len(split))
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.tokens = np.concatenate([self.tokens, np.fromiter(chain.from_iterable(split), np.int32, int(sizes.sum()))])
        return np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))

    def lists(self, pieces: np.ndarray, per_row: np.ndarray) -> pa.ListArray:
        """The tokens of rows that are so many pieces each."""
        sizes = self.starts[pieces + 1] - self.starts[pieces]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        spread = np.arange(total) + np.repeat(self.starts[pieces] - (ends - sizes), sizes)
        cuts = np.concatenate([[0], np.cumsum(per_row)])
        offsets = np.concatenate([[0], ends])[cuts].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.tokens[spread]))


def _pieces(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different pieces between white space, the number of each piece in its order, and pieces per row."""
    data, offsets = byte_views(texts)
    start, end = bounds(data, offsets, ~SPACE)
    cuts = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    letters = np.ascontiguousarray(data[~SPACE[data]])
    coded = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(cuts), pa.py_buffer(letters)).dictionary_encode()
    row = np.searchsorted(offsets, start, side="right") - 1
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.bincount(row, minlength=len(offsets) - 1)


def _marked_pieces(text: str, marks: re.Pattern) -> list[str]:
    """The pieces of a text that special tokens are written in; these keep their spelling behind a space."""
    pieces, at = [], 0
    for m in marks.finditer(text):
        pieces += [*filter(None, SPACES.split(text[at : m.start()])), " " + m[0]]
        at = m.end()
    return [*pieces, *filter(None, SPACES.split(text[at:]))]


def encode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Add the token ids of ``text`` as an array<int> column in place of the text.

    Returns doc_id and the ids, one row per row of ``docs``, in their partitions: no shuffle.
    Null and empty texts give no ids. Special tokens written in a text become their ids. Texts and words may be of any
    length: time grows with n log n for a word of n characters, and memory by some 100 bytes a byte of the longest text. Further
    columns are ignored.
    """
    bpe = WordBpe(path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(bpe)
        marks = re.compile("|".join(map(re.escape, bpe.special))) if bpe.special else None
        for whole in batches:
            for batch in slices(whole):
                texts = pc.fill_null(batch.column("text"), "")
                marked = np.zeros(len(texts), bool)
                for special in bpe.special:
                    marked |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
                turns = np.flatnonzero(np.diff(marked, prepend=~marked[:1]))
                for low, high in zip(turns, [*turns[1:], len(texts)], strict=True):
                    part = texts.slice(low, high - low)
                    if marked[low]:
                        cuts = [_marked_pieces(t, marks) for t in part.to_pylist()]
                        different = list(dict.fromkeys(chain.from_iterable(cuts)))
                        number = {p: i for i, p in enumerate(different)}
                        order = np.fromiter((number[p] for p in chain.from_iterable(cuts)), np.int64)
                        per_row = np.fromiter(map(len, cuts), np.int64)
                    else:
                        different, order, per_row = _pieces(part)
                    column = memory.lists(memory.places(different)[order], per_row)
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), column], ["doc_id", ids])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, {ids} array<int>"
    )


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the decoded text to a table with token ids: the tokens' spellings joined by spaces.

    A null array decodes to null, an empty one to the empty text; ids without a token are skipped.
    """
    names = WordBpe(path).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = pa.array(names)
        for batch in batches:
            column = batch.column(ids)
            known = column.flatten()
            if len(known) and (pc.min(known).as_py() < 0 or pc.max(known).as_py() >= len(names)):
                lists = [None if x is None else [i for i in x if i is not None and 0 <= i < len(names)] for x in column.to_pylist()]
                column = pa.array(lists, pa.list_(pa.int32()))
            row = pc.list_parent_indices(column).to_numpy()
            sizes = np.bincount(row, minlength=len(column))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            parts = pa.ListArray.from_arrays(pa.array(offsets), spelled.take(column.flatten()))
            made = pc.if_else(column.is_valid(), pc.binary_join(parts, " "), None)
            yield pa.RecordBatch.from_arrays([*batch.columns, made.cast(pa.string())], [*batch.schema.names, text])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, `{text}` string")
