"""Token counts by compiled finite-state transducers.

Splitting is a deterministic transducer over eight character classes whose transitions say which tokens begin. Texts are
cut into chunks; each chunk yields a state map (end state for every start state), the maps compose by a parallel prefix
scan, and a second pass from the then known start states emits. The words so found are arcs of a second transducer,
annotated with the number of tokens that byte-pair merging emits for them; an arc is compiled when it is first met. Words
of a block meet by a 64-bit key, from prefix sums, and are compared letter by letter, so words that share a key by chance
or by design keep their own counts.

Defined results: a null or empty text has 0 bytes and 0 tokens; strings of special tokens count as one token, as the
library's default has it; a text is counted in stretches that end at a blank, and a word of any length is one arc;
repeated rows count each for itself; further columns are not looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.core import load

LIMIT = 2048
CHUNK = 128
AT_ONCE = 1 << 20
TOGETHER = 2048  # texts taken from a batch together
MOST_ARCS, LONGEST_KEPT = 1_000_000, 256  # arcs that a process keeps, and characters of the longest; others are compiled again
# fixed values: character classes, and the states after a character of them
BLANK, LETTER, NUMBER, OTHER, QUOTE, STMD, RV, L, E = range(9)
OUTSIDE, IN_WORD, AFTER_NUMBER, IN_OTHER, AFTER_QUOTE, QUOTE_RV, QUOTE_L, AFTER_SUFFIX = range(8)
BEGINS, BEGAN = 1, 2  # a token begins at this character; one began at the character before


def compile_splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, output) by state and class for: 's|'t|'re|'ve|'m|'ll|'d|letters+|number|(neither blank, letter nor number)+."""
    to, says = np.zeros((8, 9), "u1"), np.zeros((8, 9), "u1")
    plain = {BLANK: OUTSIDE, NUMBER: AFTER_NUMBER, OTHER: IN_OTHER, QUOTE: AFTER_QUOTE}
    for state in range(8):
        for kind in range(9):
            letter = kind not in plain
            after = IN_WORD if letter else plain[kind]
            out = 0 if kind == BLANK else BEGINS
            if state == IN_WORD and letter:
                out = 0
            elif state in (IN_OTHER, AFTER_QUOTE) and kind in (OTHER, QUOTE):
                after, out = IN_OTHER, 0
            elif state == AFTER_QUOTE and kind in (STMD, RV, L):
                after, out = {STMD: AFTER_SUFFIX, RV: QUOTE_RV, L: QUOTE_L}[kind], 0
            elif (state, kind) in ((QUOTE_RV, E), (QUOTE_L, L)):
                after, out = AFTER_SUFFIX, 0
            elif state in (QUOTE_RV, QUOTE_L):  # the quote stood alone, and the letter after it began a word
                out = BEGAN if letter else BEGAN | out
            to[state, kind], says[state, kind] = after, out
    return to, says


@functools.cache
def compile_classes() -> np.ndarray:
    """The class of every code point, by the library's own regular expressions, so that both know the same letters."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    valid = np.array([c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000])
    line, kinds = "".join(map(chr, valid.tolist())), np.full(sys.maxunicode + 1, OTHER, "u1")
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
        for _, (start, end) in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(line):
            kinds[valid[start:end]] = kind
    for chars, kind in (("'", QUOTE), ("stmd", STMD), ("rv", RV), ("l", L), ("e", E)):
        kinds[[ord(c) for c in chars]] = kind
    return kinds


def run_splitter(kinds: np.ndarray, to: np.ndarray, says: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Where tokens begin (bool by character; the last one is a blank), over chunks whose state maps compose by a prefix scan."""
    n = len(kinds)
    lanes = -(-n // chunk)
    grid = np.full(lanes * chunk, BLANK, "u1")
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(lanes, chunk).T)
    flat_to, flat_says = (to.astype("i4") * 9).reshape(-1), says.reshape(-1)  # states as row offsets
    states = np.broadcast_to(np.arange(8, dtype="i4") * 9, (lanes, 8)).copy()
    for row in grid:
        states = flat_to[states + row[:, None]]
    maps, step = states // 9, 1
    while step < lanes:  # composition is associative: after each round a map spans twice as many chunks
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], axis=1)
        step *= 2
    state = np.zeros(lanes, "i4")
    state[1:] = maps[:-1, OUTSIDE] * 9
    out = np.empty((chunk, lanes), "u1")
    for row, said in zip(grid, out):
        at = state + row
        said[:] = flat_says[at]
        state = flat_to[at]
    out = out.T.reshape(-1)[:n]
    begins = (out & BEGINS).astype(bool)
    begins[:-1] |= (out[1:] & BEGAN).astype(bool)
    return begins


class WordArcs:
    """word -> emitted tokens, by byte-pair merging with word ends."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            model = json.load(f)
        merges = model["model"]["merges"]
        self.ranks = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): k for k, m in enumerate(merges)}
        self.special = [t["content"] for t in model["added_tokens"]]
        self.end = model["model"]["end_of_word_suffix"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256
        rest = [b for b in range(256) if b not in set(shown)]
        self.char = {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(rest)}}
        self.counts: dict[str, int] = {}

    def emitted(self, word: str) -> int:
        parts = [self.char[b] for b in word.encode()]
        parts[-1] += self.end
        rank, none = self.ranks.get, len(self.ranks)
        while len(parts) > 1:
            pairs = [rank(p, none) for p in zip(parts, parts[1:])]
            least = min(pairs)
            if least == none:
                break
            left, right = parts[pairs.index(least)], parts[pairs.index(least) + 1]
            merged, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and parts[k] == left and parts[k + 1] == right:
                    merged.append(left + right)
                    k += 2
                else:
                    merged.append(parts[k])
                    k += 1
            parts = merged
        return len(parts)

    def emitted_long(self, word: str) -> int:
        """The same for long words, in n log n: a heap of pairs over a linked list."""
        parts = [self.char[b] for b in word.encode()]
        parts[-1] += self.end
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, parts[k], parts[k + 1]) for k in range(n - 1) if (r := self.ranks.get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k]
            if parts[k] != a or j >= n or parts[j] != b:
                continue
            parts[k], parts[j], after[k] = a + b, None, after[j]
            left -= 1
            if after[k] < n:
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < n and (r := self.ranks.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return left

    def look_up(self, words: list[str]) -> np.ndarray:
        """The tokens that each word's arc emits; arcs not met before are compiled."""
        out = [self.counts.get(w) for w in words]
        new = {w for w, c in zip(words, out) if c is None}
        if new:
            if len(self.counts) + len(new) > MOST_ARCS:  # arcs can be compiled again; memory stays bounded
                self.counts = {}
            made = {w: self.emitted(w) if len(w) < 64 else self.emitted_long(w) for w in new}
            self.counts |= {w: c for w, c in made.items() if len(w) <= LONGEST_KEPT}
            out = [made[w] if c is None else c for w, c in zip(words, out)]
        return np.array(out, "i8")


class Counter:
    """Counts the tokens of many texts together."""

    def __init__(self, file: str, kinds: np.ndarray):
        self.arcs = WordArcs(file)
        self.to, self.says = compile_splitter()
        self.kinds = kinds
        self.special = re.compile("|".join(map(re.escape, self.arcs.special)))
        base = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, "u8")

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, factor in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(n, factor, "u8")
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype="u8"))

    @staticmethod
    def normal(text: str) -> str:
        """NFC, then lower case character by character (a final sigma is not told apart)."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def parts(self, texts: list[str], extra: np.ndarray):
        """(text number, normal form) of stretches between special strings, long ones cut at a blank; extra counts the former."""
        for k, text in enumerate(texts):
            pieces = [text]
            if "<|" in text:
                pieces = self.special.split(text)
                extra[k] += len(pieces) - 1
            for p in pieces:
                a = 0
                while len(p) - a > AT_ONCE and (b := p.find(" ", a + AT_ONCE)) >= 0:
                    yield k, self.normal(p[a:b]) + "\n"
                    a = b
                yield k, self.normal(p[a:]) + "\n"  # a blank ends the last word

    def count(self, texts: list[str]) -> np.ndarray:
        totals = np.zeros(len(texts), "i8")
        owner, parts, held = [], [], 0
        for k, part in self.parts(texts, totals):
            owner.append(k)
            parts.append(part)
            held += len(part)
            if held >= AT_ONCE:
                np.add.at(totals, owner, self.count_parts(parts))
                owner, parts, held = [], [], 0
        if parts:
            np.add.at(totals, owner, self.count_parts(parts))
        return totals

    def count_parts(self, parts: list[str]) -> np.ndarray:
        line = "".join(parts)
        codes = np.frombuffer(line.encode("utf-32-le"), "<u4")
        kinds = self.kinds[codes]
        begins = np.flatnonzero(run_splitter(kinds, self.to, self.says))
        if not len(begins):
            return np.zeros(len(parts), "i8")
        # a word ends where the next begins, or at the first blank after it
        blanks = np.flatnonzero(kinds == BLANK)
        ends = np.minimum(np.append(begins[1:], len(codes)), blanks[np.searchsorted(blanks, begins)])
        counts = self.counts_of(line, codes, begins, ends)
        total = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(total[np.searchsorted(begins, np.cumsum([0, *map(len, parts)]))])


    def counts_of(self, line: str, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """What each word emits. Words meet by hash, and are then compared letter by letter with the first of their hash."""
        self.grow(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, "u8")
        np.cumsum((codes.astype("u8") + np.uint64(1)) * self.powers[: len(codes)], out=sums[1:])
        lengths = ends - begins
        keys = (sums[ends] - sums[begins]) * self.inverses[begins]
        keys ^= lengths.astype("u8") << np.uint64(56)
        _, first, where = np.unique(keys, return_index=True, return_inverse=True)
        counts = self.arcs.look_up([line[a:b] for a, b in zip(begins[first].tolist(), ends[first].tolist())])[where]
        like = first[where]
        odd = lengths != lengths[like]
        word = np.repeat(np.arange(len(begins)), lengths)
        at = np.arange(len(word)) + np.repeat(begins - (np.cumsum(lengths) - lengths), lengths)
        other = at + np.repeat(begins[like] - begins, lengths)
        odd[word[codes[at] != codes[np.minimum(other, len(codes) - 1)]]] = True
        if odd.any():
            k = np.flatnonzero(odd)
            counts[k] = self.arcs.look_up([line[a:b] for a, b in zip(begins[k].tolist(), ends[k].tolist())])
        return counts


_COUNTERS: dict[str, Counter] = {}


def counter(name: str, kinds: np.ndarray) -> Counter:
    if name not in _COUNTERS:
        import public_tokenizers

        _COUNTERS[name] = Counter(public_tokenizers.path(name), kinds)
    return _COUNTERS[name]


def token_counts(spark: SparkSession, docs: DataFrame, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every whole text. The table of classes, of fixed size, is compiled once and broadcast."""
    shared = spark.sparkContext.broadcast(compile_classes())

    def run(batches):
        count = counter(tokenizer, shared.value).count
        for batch in (b.slice(a, TOGETHER) for b in batches for a in range(0, b.num_rows, TOGETHER)):
            texts = [t.as_py() or "" for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(count(texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, load(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > LIMIT)
