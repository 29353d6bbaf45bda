"""Token counts by finite-state transducers with emitted-token counts, composed over chunks by a parallel prefix scan.

Two machines in cascade stand for a word-level BPE tokenizer. The first reads character classes and marks where
pre-tokens start; its chunks are state maps, which compose associatively. The second reads the bytes of a pre-token and is
compiled from the vocabulary and the merges: a transition's label is by how many tokens the word's count changes. It starts
anew with each pre-token, so the marks of the first are all that chunks have to tell each other. No text is given to a
tokenizer's library, which only normalizes characters beyond Latin ones.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

CHUNK = 512
#: Words whose counts a task keeps, and states that its machine keeps; beyond, it starts anew and compiles what it meets.
LEXICON, STATES = 1_000_000, 300_000
LAST = 256  # added to the last byte of a word, a symbol of its own
# Classes of characters, and states of the pre-token machine. Contractions are 's 't 'm 'd 're 've 'll.
GAP, LETTER, DIGIT, OTHER, QUOTE, SHORT, C_R, C_V, C_L, C_E = range(10)
OPEN, IN_WORD, IN_OTHER, QUOTED, Q_R, Q_V, Q_L = range(7)
# The White_Space property of Unicode
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) by class and state. Mark 1: a pre-token starts here; 2: one started a character before."""
    step, mark = np.zeros((10, 7), np.uint8), np.zeros((10, 7), np.uint8)
    letters = (LETTER, SHORT, C_R, C_V, C_L, C_E)
    for state in range(7):
        late = 2 if state in (Q_R, Q_V, Q_L) else 0  # a quote and a letter wait; they part unless a contraction follows
        step[GAP, state], mark[GAP, state] = OPEN, late
        step[DIGIT, state], mark[DIGIT, state] = OPEN, 1 | late
        step[OTHER, state], mark[OTHER, state] = IN_OTHER, (0 if state in (IN_OTHER, QUOTED) else 1) | late
        step[QUOTE, state], mark[QUOTE, state] = (IN_OTHER, 0) if state in (IN_OTHER, QUOTED) else (QUOTED, 1 | late)
        for c in letters:
            step[c, state], mark[c, state] = IN_WORD, (0 if state in (IN_WORD, Q_R, Q_V, Q_L) else 1) | late
    for c, then in ((SHORT, OPEN), (C_R, Q_R), (C_V, Q_V), (C_L, Q_L)):
        step[c, QUOTED], mark[c, QUOTED] = then, 0
    for c, state in ((C_E, Q_R), (C_E, Q_V), (C_L, Q_L)):
        step[c, state], mark[c, state] = OPEN, 0
    return step.ravel(), mark.ravel()


STEP, MARK = _machine()


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, c in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT)):
        for m in regex.finditer(kind, every):
            table[ord(m[0][0]) : ord(m[0][-1]) + 1] = c
    table[0xD800:0xE000] = OTHER
    table[WHITE] = GAP
    for c, chars in ((QUOTE, "'"), (SHORT, "stmd"), (C_R, "r"), (C_V, "v"), (C_L, "l"), (C_E, "e")):
        table[[ord(x) for x in chars]] = c
    return table


def starts_by_scan(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Marks of the characters where pre-tokens start.

    All chunks run side by side from every state, which gives each chunk's state map; a prefix scan composes the maps
    in log(chunks) steps; then all run once more from their true states and emit.
    """
    n = len(classes)
    lanes = -(-n // chunk)
    c = np.full(lanes * chunk, GAP, np.uint8)
    c[:n] = classes
    c = np.ascontiguousarray(c.reshape(lanes, chunk).T).astype(np.intp) * 7
    maps = np.tile(np.arange(7, dtype=np.uint8), (lanes, 1))
    for row in c:
        maps = STEP[row[:, None] + maps]
    gap = 1
    while gap < lanes:
        later = maps.copy()
        later[gap:] = np.take_along_axis(maps[gap:], maps[:-gap].astype(np.intp), axis=1)
        maps, gap = later, gap * 2
    state = np.zeros(lanes, np.uint8)
    state[1:] = maps[:-1, OPEN]
    out = np.empty(c.shape, np.uint8)
    for i, row in enumerate(c):
        at = row + state
        out[i], state = MARK[at], STEP[at]
    marks = out.T.ravel()[:n]
    starts = (marks & 1).astype(bool)
    starts[:-1] |= (marks[1:] & 2).astype(bool)
    return starts


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, and for the
    others, in order, the characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


class WordMachine:
    """A deterministic transducer from the bytes of a word to its number of BPE tokens, compiled transition by transition.

    The tokens of a word's prefix, taken as if no more came, end in one token; before it lie the tokens of a shorter prefix. So
    the last token of a longer prefix is the one vocabulary entry that ends there and may follow the last token of
    the prefix before it. A state is therefore the longest end of what was read that may begin an entry, and for it and
    each shorter such end: the last token of the prefix before that end, and that prefix's count less the present one. Such
    ends are no longer than entries are, so the states are finitely many; those that words reach are compiled.
    """

    def __init__(self, model: dict):
        vocab, byte = model["vocab"], byte_of()
        self.rank, self.left, self.right = [-1] * len(vocab), [0] * len(vocab), [0] * len(vocab)
        self.merges: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            both = vocab[a + b]
            self.rank[both], self.left[both], self.right[both] = rank, vocab[a], vocab[b]
            self.merges[vocab[a], vocab[b]] = rank
        # A trie of the entries by symbols; shorter[n] is the node of the longest proper end of n's symbols in the trie.
        self.after, self.entry, self.depth = [{}], [-1], [0]
        for word, i in vocab.items():
            symbols = [byte[c] for c in word.removesuffix("</w>")]
            symbols[-1] += LAST * word.endswith("</w>")
            at = 0
            for x in symbols:
                if x not in self.after[at]:
                    self.after[at][x] = len(self.after)
                    self.after.append({}), self.entry.append(-1), self.depth.append(self.depth[at] + 1)
                at = self.after[at][x]
            self.entry[at] = i
        self.shorter = [0] * len(self.after)
        queue = deque(self.after[0].values())
        while queue:
            at = queue.popleft()
            for x, to in self.after[at].items():
                self.shorter[to] = self.follow(self.shorter[at], x)
                queue.append(to)
        self.shared: dict[tuple[int, int], tuple[int, int]] = {}
        self.clear()

    def clear(self) -> None:
        self.states = {(0, ((-1, 0),)): 0}
        self.meaning = list(self.states)
        self.step: dict[int, tuple[int, int]] = {}
        self.adjacent: dict[tuple[int, int], bool] = {}

    def follow(self, node: int, symbol: int) -> int:
        """The node of the longest end of (node's symbols, symbol) in the trie."""
        while symbol not in self.after[node]:
            if not node:
                return 0
            node = self.shorter[node]
        return self.after[node][symbol]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether a text that is the entries a and b has just these two as tokens: that is, no merge joins what ends a and
        what begins b, at a time when both are there. Time is undone: of the two, the part made later goes first."""
        before = 2 * len(self.rank)
        while True:
            across = self.merges.get((a, b))
            if across is not None and 2 * across < before:
                return False
            if self.rank[a] > self.rank[b]:
                before, a = 2 * self.rank[a], self.right[a]
            elif self.rank[b] >= 0:  # of equal merges the left one comes first, so one across comes before one in b
                before, b = 2 * self.rank[b] + 1, self.left[b]
            else:
                return True

    def compile(self, state: int, symbol: int) -> tuple[int, int]:
        """(next state, change of the count) of a transition that no word took before."""
        node, known = self.meaning[state]
        at, n = {}, node  # by the length of an end: (last token before it, that prefix's count less the present one)
        for pair in known:
            at[self.depth[n]] = pair
            n = self.shorter[n]
        to = n = self.follow(node, symbol)
        while n:
            token = self.entry[n]
            if token >= 0:
                last, count = at[self.depth[n] - 1]
                if last < 0 or self.adjacent_pair(last, token):
                    break
            n = self.shorter[n]
        else:
            raise ValueError("a byte without an entry of its own")
        change, ends, n = count + 1, [], to
        while n:
            last, count = at[self.depth[n] - 1]
            ends.append((last, count - change))
            n = self.shorter[n]
        ends.append((token, 0))
        meaning = (0, ()) if symbol >= LAST else (to, tuple(self.shared.setdefault(e, e) for e in ends))
        number = self.states.setdefault(meaning, len(self.meaning))
        if number == len(self.meaning):
            self.meaning.append(meaning)
        self.step[state << 9 | symbol] = number, change
        return number, change

    def adjacent_pair(self, a: int, b: int) -> bool:
        if (a, b) not in self.adjacent:
            self.adjacent[a, b] = self.may_follow(a, b)
        return self.adjacent[a, b]

    def count(self, word: bytes) -> int:
        """The sum of what the transitions of a word emit."""
        if len(self.meaning) > STATES:
            self.clear()
        state, total, step = 0, 0, self.step
        for symbol in (*word[:-1], word[-1] + LAST):
            state, change = step.get(state << 9 | symbol) or self.compile(state, symbol)
            total += change
        return total


class Counter:
    """Counts tokens as the tokenizers library gives them for a BPE json with word ends, such as lower-cased word BPE."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.normalizer = Tokenizer.from_file(path).normalizer
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.machine = WordMachine(told["model"])
        self.special = re.compile("|".join(re.escape(t["content"]) for t in told["added_tokens"]) or r"(?!)")
        self.lexicon: dict[str, int] = {}

    def normal(self, text: str) -> str:
        """Composed and lower-cased. Where Python's rules might differ from the library's, the library does it."""
        if text.isascii():
            return text.lower()
        if max(text) < "ɐ" and unicodedata.is_normalized("NFC", text):
            return text.lower()
        return self.normalizer.normalize_str(text)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; special strings count one each."""
        extra, parts = np.zeros(len(texts), np.int64), []
        for i, text in enumerate(texts):
            if "<|" in text:
                text, extra[i] = self.special.subn(" ", text)
            parts.append(self.normal(text))
        whole = "\n".join([*parts, ""])
        if not texts:
            return extra
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = _classes()[points]
        starts = starts_by_scan(classes)
        first = np.flatnonzero(starts)
        closed = np.ones(len(points), bool)
        closed[:-1] = (classes[1:] == GAP) | starts[1:]
        after = np.flatnonzero((classes != GAP) & closed) + 1
        words = [whole[a:b] for a, b in zip(first.tolist(), after.tolist(), strict=True)]
        emitted = list(map(self.lexicon.get, words))
        if missing := {w for w, n in zip(words, emitted, strict=True) if n is None}:
            if len(self.lexicon) + len(missing) > LEXICON:  # start anew with the words of these texts
                self.lexicon.clear()
                missing = set(words)
            self.lexicon.update((w, self.machine.count(w.encode())) for w in missing)
            emitted = [self.lexicon[w] for w in words]
        bounds = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        sums = np.concatenate([[0], np.cumsum(np.array(emitted, np.int64))])
        return extra + np.diff(sums[np.searchsorted(first, bounds)])


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, portion: int = 1 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row; null and empty texts have 0 of both.

    Each row is counted where it is read: one pass, no shuffle, memory bounded by `portion` characters of text (or one
    longer text), LEXICON words and STATES states. path: the tokenizer's json, on every executor. Repeated rows get equal
    results, a null id stays null, an empty table gives an empty one, and columns other than the two named aren't read.
    """
    bounded_batches(docs.sparkSession)

    def count(batches):
        machine = counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out, at = [], 0
            while at < len(texts):
                after, size = at + 1, len(texts[at])
                while after < len(texts) and size + len(texts[after]) <= portion:
                    size += len(texts[after])
                    after += 1
                out.append(machine.counts(texts[at:after]))
                at = after
            n = np.concatenate([np.zeros(0, np.int64), *out])
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
