"""Language-model scoring by online logistic context mixing.

A text is coded word by word (in lower case), with an end after the last, as bits:

* where other texts continued the two words before: whether the commonest continuation comes. So passages and documents
  that the corpus repeats cost little;
* else whether the word is copied from this text, where it is chosen by how often it occurred before, or spelled, byte by
  byte, as branches of Huffman trees of the training bytes (one tree for each byte before), with a blank at its end. A word
  that both ways lead to has the sum of their probabilities.

Each bit is predicted by several hashed contexts: branches by the word's last three and five bytes and by the whole word
so far, flags by what the corpus and this text did before in like places. Their logits are combined by weights that a
gate selects (how often the contexts were seen, how many continuations came true in a row, how far the text has come),
and a last stage corrects the mixed probability by what became of those like it. Weights and last stage are learned
online, and for the flags they go on learning within each text, chunk by chunk, always from what lies behind. The spelling of
a word depends on the word alone, so each distinct word of a block is spelled once. Scores are total bits, as a proper
code would need them, and equal texts score alike wherever they stand.

Counts cover all training texts, and grow with them: exact counts of every word and of every three words are added up by
shuffles, and never meet in one place; what is broadcast are the spelling contexts, hashed to tables that grow with the
distinct words up to 2^22 slots, and with their root beyond (one byte a slot). A training text's own three-word counts
are taken out when it is scored, so that it is not predicted by itself; a copy elsewhere still predicts it.
Mixing starts from weights learned on one in ``TUNE_PARTS`` of the training texts, chosen by a hash, of any length and
at any size of the table; for that the spelling counts leave these texts out, and take them in again for the scores.

Defined results: a null or empty text is its end alone; a null doc_id counts as the empty string in its fold; repeated
rows score alike; texts and words of any length are coded whole (a task needs some 200 bytes for each word of its longest
text); without training texts all counts are zero, and every first branch has probability one half; further columns are
not looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
import struct
import uuid
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.core import load, materialize, scratch

END = b"\n"  # the end's spelling; no word has it
BLANK = 32
BLOCK_BYTES = 6 << 20  # bytes of text that share a dictionary
PART_ENTRIES = 1 << 20  # words and continuations that a task adds up
STRETCH = 1 << 18  # bytes of a text that are split into words together
TUNE_PARTS = 16
INPUTS, TABLES = 4, 3
LEAST_BITS = (18, 20, 20)  # log2 of the slots of each table, at least
LINEAR_BITS = 22  # tables grow with the distinct words up to here, and with their root beyond
SLOTS_A_WORD = (2, 8, 16)
PART = 17  # log2 of the slots that travel in one row
ENTRIES = 1 << 16  # bytes spelled, or words coded, together: as much as a processor's own cache takes
COUNTED = 1 << 22  # branches counted before they are added up
CLIP, STEPS = 8.4, 31  # of a packed logit, to either side of zero
SPELL_GATES = 4 * 4
RUNS = np.array([0, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4, 4, 4, 4, 4, 5])  # runs of continuations that came true, in six steps
RUN_GATES, PLACE_GATES = 6 * 4 * 2, 16 * 2
FLAG_GATES = RUN_GATES + PLACE_GATES
RARE = 2  # how often a word may occur in a block to be numbered by its spelling
CHUNK = 128  # flags between two refinements
RATE = 0.01
LEVELS, SURE = 33, 60.0  # of the last stage: steps of the mixed logit, and how many bits its start counts for
LESSON = 512  # words spelled between two steps of the spelling weights
UNITS = float(1 << 34)  # of added logarithms
MASK = (1 << 64) - 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # of bytes: A-Z only, and the six ASCII blanks


def fold(doc_id: Column, parts: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


# --- spelling


@dataclass
class Trees:
    """The branches of every byte after every byte: salts[first[p] : first[p] + length[p]] with p = before * 256 + byte, and the ways taken there."""

    first: np.ndarray
    length: np.ndarray
    salts: np.ndarray
    ways: np.ndarray


def huffman(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """(node, way) along the path to each of 256 bytes; ties go to the smaller byte, so equal counts give equal trees."""
    heap = [(int(c) + 1, b, b) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    parent, fresh = {}, 256
    while len(heap) > 1:
        (ca, ka, a), (cb, kb, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a], parent[b] = (fresh, 0), (fresh, 1)
        heapq.heappush(heap, (ca + cb, min(ka, kb), fresh))
        fresh += 1
    paths = []
    for b in range(256):
        path, at = [], b
        while at in parent:
            at, way = parent[at]
            path.append((at - 256, way))
        paths.append(path[::-1])
    return paths


def trees_of(counts: np.ndarray) -> Trees:
    """Trees from how often each byte (column) follows each byte (row)."""
    first, length, nodes, ways = [], [], [], []
    made: dict[bytes, list] = {}
    for before, row in enumerate(counts):
        paths = made.setdefault(row.tobytes(), None) or made.update({row.tobytes(): huffman(row)}) or made[row.tobytes()]
        for path in paths:
            first.append(len(nodes))
            length.append(len(path))
            nodes += [before * 256 + n for n, _ in path]
            ways += [w for _, w in path]
    return Trees(np.array(first, "i4"), np.array(length, "i4"), np.array(nodes, "u4") * np.uint32(0x9E3779B1), np.array(ways, "u1"))


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x2545F4914F6CDD1D
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(max(n, 1), factor, "u8")
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype="u8"))
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Letters:
    """The bytes of words, each with its blank, or of the end: a 32-bit hash of each context of each byte, each byte after the one
    before (before * 256 + byte), and where each word begins (and the last ends)."""

    contexts: np.ndarray
    path: np.ndarray
    edges: np.ndarray


def letters(words: list[bytes]) -> Letters:
    """Contexts do not look beyond the word."""
    parts = [w if w == END else w + b" " for w in words]
    line = np.frombuffer(b"".join(parts), "u1")
    sizes = np.fromiter(map(len, parts), "i8", len(parts))
    begins = np.cumsum(sizes) - sizes
    begin = np.repeat(begins, sizes)
    place = np.arange(len(line)) - begin
    wide = line.astype("u8") + np.uint64(1)

    def earlier(x, k):  # what x has k bytes before, in the same word
        out = np.zeros(len(x), "u8")
        out[k:] = x[: len(x) - k]
        out *= place >= k
        return out

    one = earlier(wide, 1)  # the last byte before, then the last two, three and five
    two = one | earlier(one, 1) << np.uint64(9)
    three = two | earlier(one, 2) << np.uint64(18)
    past = three, three | earlier(two, 3) << np.uint64(27)
    power, inverse = powers(len(line) + 1)
    sums = np.zeros(len(line) + 1, "u8")
    np.cumsum(wide * power[: len(line)], out=sums[1:])
    keys = (past[0] + np.uint64(1 << 50), past[1] + np.uint64(2 << 50), (sums[:-1] - sums[begin]) * inverse[begin] + np.uint64(3))
    contexts = np.stack([(mixed(k) >> np.uint64(32)).astype("u4") for k in keys])
    before = np.full(len(line), BLANK, "i4")
    before[1:] = line[:-1]
    before[begins[sizes > 0]] = BLANK
    return Letters(contexts, before * 256 + line, np.append(begins, len(line)))


def branches(trees: Trees, path: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(byte, hash of the node, way) of every branch taken to bytes after bytes."""
    length = trees.length[path]
    ends = np.cumsum(length)
    byte = np.repeat(np.arange(len(path), dtype="i4"), length)
    at = np.arange(len(byte), dtype="i4") + (trees.first[path] - (ends - length).astype("i4"))[byte]
    return byte, trees.salts.take(at), trees.ways.take(at)


def in_stretches(words: list[bytes], numbers: np.ndarray, most: int):
    """(words, numbers) in runs of about ``most`` bytes."""
    a = held = 0
    for k, w in enumerate(words):
        held += len(w) + 1
        if held >= most:
            yield words[a : k + 1], numbers[a : k + 1]
            a, held = k + 1, 0
    if a < len(words):
        yield words[a:], numbers[a:]


def table_bits(words: int) -> tuple[int, ...]:
    """log2 of the slots of each table for a number of distinct words."""
    full = [max(least, (each * words - 1).bit_length()) for least, each in zip(LEAST_BITS, SLOTS_A_WORD)]
    return tuple(b if b <= LINEAR_BITS else min(32, LINEAR_BITS + (b - LINEAR_BITS + 1) // 2) for b in full)


def offsets_of(bits: tuple[int, ...]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([1 << b for b in bits])]).astype("i8")


def slots(contexts: np.ndarray, byte: np.ndarray, salt: np.ndarray, bits: int) -> np.ndarray:
    """The slot of each branch in a table of 2^bits slots."""
    return (contexts.take(byte) ^ salt) >> np.uint32(32 - bits)


def ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys, and where each distinct one first stands in it."""
    order = np.argsort(keys)
    own = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))[: len(own)]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the number of each key's."""
    order, first = ordered(keys)
    which = np.empty(len(keys), "i8")
    which[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    return keys[order[first]], which


def packed_logits(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """What a slot says in one byte: its logit in steps of 0.27, and how often it was seen in four."""
    x = np.clip(np.log((ones + 0.4) / (zeros + 0.4)), -CLIP, CLIP)
    return (np.rint(x * (STEPS / CLIP)).astype("i4") + STEPS << 2 | np.digitize(zeros + ones, (1, 3, 12))).astype("u1")


LOGITS = (((np.arange(256) >> 2) - STEPS) * (CLIP / STEPS)).astype("f4")
UNSEEN = STEPS << 2


def counted(words: list[bytes], counts: np.ndarray, trees: Trees, bits: tuple[int, ...]):
    """(keys, sums) of each stretch of words in each table: keys are slots, times two, and the way taken there, some more than once; sums have the
    two columns of ``counts``. In the table of whole words a word counts as often as it occurs; in the others once, as they
    are for words not met before."""
    offsets = offsets_of(bits)
    for some, times in in_stretches(words, counts, 4 * ENTRIES):
        s = letters(some)
        size, path = np.diff(s.edges), s.path.astype("u8")
        kind = np.repeat((times > 0) @ np.array([1, 2]), size).astype("u8")
        for k in range(TABLES):  # what follows a context is counted by byte, and then by the branches to it
            keys = s.contexts[k].astype("u8") << np.uint64(18) | path << np.uint64(2)
            if k < TABLES - 1:
                keys |= kind
                keys.sort()
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                n, keys = np.diff(np.append(first, len(keys))), keys[first]
                n = [n * (keys & np.uint64(c) > 0) for c in (1, 2)]
            else:
                order, first = ordered(keys)
                word = np.repeat(np.arange(len(some)), size)[order]
                n, keys = [np.add.reduceat(t[word], first) for t in times.T], keys[order[first]]
            byte, salt, way = branches(trees, (keys >> np.uint64(2) & np.uint64(0xFFFF)).astype("i4"))
            yield (slots((keys >> np.uint64(18)).astype("u4"), byte, salt, bits[k]) + offsets[k]) * 2 + way, np.stack([c.take(byte) for c in n])


# --- mixing


def seen_before(keys: np.ndarray, way: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(times seen, ones) of each key before its place."""
    room = np.uint64(max(1, len(keys).bit_length()))
    if len(keys) and int(keys.max()).bit_length() + int(room) > 64:
        keys = distinct(keys)[1].astype("u8")
    own = np.sort(keys << room | np.arange(len(keys), dtype="u8"))
    grouped, own = own >> room, (own & ((np.uint64(1) << room) - np.uint64(1))).astype("i8")
    first = np.flatnonzero(np.concatenate([[True], grouped[1:] != grouped[:-1]]))[: len(own)]
    size = np.diff(np.append(first, len(own)))
    sums = np.concatenate([[0], np.cumsum(way[own], dtype="i8")])
    out = np.empty((2, len(own)), "i8")
    out[0, own] = np.arange(len(own)) - np.repeat(first, size)
    out[1, own] = sums[:-1] - np.repeat(sums[first], size)
    return out[0], out[1]


@dataclass
class Mixer:
    """What mixing starts from: weights (inputs x gates), and ones and bits of the last stage by kind and level."""

    weights: np.ndarray
    ones: np.ndarray
    n: np.ndarray

    @classmethod
    def new(cls, weights: np.ndarray, kinds: int) -> Mixer:
        level = 1 / (1 + np.exp(-(np.arange(LEVELS) - LEVELS // 2) / 2.0))
        return cls(weights, np.tile(level * SURE, kinds), np.full(kinds * LEVELS, SURE))

    @classmethod
    def spelling(cls) -> Mixer:
        return cls.new(np.full((TABLES, SPELL_GATES), 0.4), 1)

    @classmethod
    def flags(cls) -> Mixer:
        return cls.new(np.tile(np.array([0.6, 0.0, 0.0, 0.4])[:, None], (1, FLAG_GATES)), 2)

    def steady(self) -> Mixer:
        """The same with the last stage's start brought back to what it counts for."""
        return Mixer(self.weights, self.ones / self.n * SURE, np.full(len(self.n), SURE))


def level_of(z: np.ndarray) -> np.ndarray:
    out = np.rint(2 * z).astype("i4")
    np.clip(out, -(LEVELS // 2), LEVELS // 2, out=out)
    out += LEVELS // 2
    return out


@dataclass
class Model:
    trees: Trees
    bits: tuple[int, ...]
    table: np.ndarray  # packed logits of all tables
    spelling: Mixer
    flags: Mixer

    def spelled(self, words: list[bytes], squares: np.ndarray | None = None) -> np.ndarray:
        """The natural log probability of each word's spelling. With ``squares``, running squares of the gradients, the words are a
        lesson, in their order: the mixer learns from every LESSON of them."""
        offsets, out, m = offsets_of(self.bits), np.empty(len(words)), self.spelling
        weighed = lambda: (m.weights[:, :, None] * LOGITS).astype("f4").reshape(TABLES, -1)  # noqa: E731  by gate and packed logit
        says, corrected = weighed(), (0.5 * m.ones / m.n).astype("f4")
        k = 0
        for some, _ in in_stretches(words, np.zeros(len(words)), ENTRIES):
            s = letters(some)
            byte, salt, ways = branches(self.trees, s.path)
            own = [self.table[offsets[t] : offsets[t + 1]].take(slots(s.contexts[t], byte, salt, self.bits[t])) for t in range(TABLES)]
            gate = (own[2] & 3).astype("u2") * 4 + (own[1] & 3)
            log = np.empty(len(gate))
            word = np.concatenate([[0], np.cumsum(self.trees.length[s.path])])[s.edges]  # where each word's branches begin
            steps = range(0, len(some), LESSON if squares is not None else LESSON << 3)
            for a, b in ((word[j], word[min(j + steps.step, len(some))]) for j in steps):
                g, way = gate[a:b], ways[a:b]
                z = says[0].take(g * 256 + own[0][a:b])
                for t in range(1, TABLES):
                    z += says[t].take(g * 256 + own[t][a:b])
                np.clip(z, -16, 16, out=z)
                p, level = 1 / (1 + np.exp(-z)), level_of(z)
                refined = 0.5 * p + corrected.take(level)
                log[a:b] = np.log(np.abs(refined - (1 - way)))
                if squares is not None:
                    step = np.stack([np.bincount(g, weights=LOGITS.take(own[t][a:b]) * (way - p), minlength=SPELL_GATES) for t in range(TABLES)])
                    squares += step * step
                    m.weights += 0.05 * step / np.sqrt(squares)
                    m.ones += np.bincount(level, weights=way, minlength=LEVELS)
                    m.n += np.bincount(level, minlength=LEVELS)
                    says, corrected = weighed(), (0.5 * m.ones / m.n).astype("f4")
            out[k : k + len(some)] = np.add.reduceat(log, word[:-1])
            k += len(some)
        return out


@dataclass
class Flags:
    """The flags of some texts, in order: inputs x flags, gate of each, what follows has by the flag's two ways, as multiples of
    what it has anyway (yes x flags, no x flags), and where each text's begin (and the last end)."""

    inputs: np.ndarray
    gate: np.ndarray
    yes: np.ndarray
    no: np.ndarray
    edges: np.ndarray


def flags_of(seq: np.ndarray, known: np.ndarray, first: np.ndarray, spelling: np.ndarray) -> Flags:
    """The flags of a block's texts; spelling: the natural log of the probability of each of their words' spelling."""
    place = np.arange(len(seq)) - np.repeat(first[:-1], np.diff(first))
    text = np.repeat(np.arange(len(first) - 1, dtype="u8"), np.diff(first))
    asked, hit = known > 0, (known > 0) & (known & 1 == 1)
    times, _ = seen_before(text * np.uint64(seq.max(initial=0) + 1) + seq.astype("u8"), np.zeros(len(seq), "u1"))
    second = ~hit & (place > 0)  # at a text's first word there is none to repeat
    at = np.concatenate([[0], np.cumsum(asked.astype("i8") + second)])
    total = int(at[-1])
    inputs, gate, way, key = np.zeros((INPUTS, total), "f4"), np.empty(total, "i4"), np.empty(total, "u1"), np.empty(total, "u8")
    yes, no = np.empty(total, "f4"), np.empty(total, "f4")
    a, b = at[:-1][asked], (at[:-1] + asked)[second]
    nt, nb = known[asked] >> 16, known[asked] >> 1 & 0x7FFF
    sure, run = (nb == nt).astype("i8"), RUNS[np.minimum(runs_of(known, first)[asked], 16)]
    inputs[0, a], inputs[1], way[a] = np.log((nb + 0.4) / (nt - nb + 0.4)), 1, hit[asked]
    gate[a], key[a] = (run * 4 + np.digitize(nt, (2, 3, 6))) * 2 + sure, 2 * run + sure
    yes[a], no[a] = hit[asked], ~hit[asked]
    yes[b], no[b] = np.exp(np.minimum(np.log(np.maximum(times[second], 1e-9) / place[second]) - spelling[second], 60)) * (times[second] > 0), 1
    way[b] = yes[b] > 1  # the likelier way is what later flags take to have happened
    whose = text[second]
    start = np.concatenate([[0], np.cumsum(second)])[first[:-1]][whose.astype("i8")]  # texts stand in order, so what one did before needs no sorting
    sums = np.concatenate([[0], np.cumsum(way[b], dtype="i8")])
    n, ones = np.arange(len(b)) - start, sums[:-1] - sums[start]
    inputs[0, b] = np.log((ones + 0.4) / (n - ones + 0.4))
    inputs[2, b] = np.log((n - ones + 1) / (n + 1))
    last = np.zeros(len(b), "u8")  # what became of the three flags of this kind before
    for j in (1, 2, 3):
        last[j:] |= np.where(whose[j:] == whose[:-j], way[b][:-j], 0).astype("u8") << np.uint64(j - 1)
    gate[b] = RUN_GATES + np.minimum(np.log2(n + 1).astype("i4"), 15) * 2 + (last & np.uint64(1)).astype("i4")
    key[b] = np.uint64(16) + last
    edges = at[first]
    own = np.repeat(np.arange(len(first) - 1, dtype="u8"), np.diff(edges))
    n, ones = seen_before(own << np.uint64(8) | key, way)
    inputs[3] = np.log((ones + 0.4) / (n - ones + 0.4))
    return Flags(inputs, gate, yes, no, edges)


def mix(flags: Flags, mixer: Mixer, squares: np.ndarray | None = None) -> np.ndarray:
    """The natural log probability of each text's flags. Texts run side by side, a chunk at a time; each learns for itself. With
    ``squares``, running squares of the gradients, what the chunks teach also moves the mixer itself."""
    sizes = np.diff(flags.edges)
    out, order = np.zeros(len(sizes)), np.argsort(-sizes, kind="stable")
    some = order[sizes[order] > 0]
    if len(some):
        out[some] = mix_side_by_side(flags, flags.edges[:-1][some], sizes[some], mixer, squares)
    return out


def mix_side_by_side(flags: Flags, starts: np.ndarray, sizes: np.ndarray, mixer: Mixer, squares: np.ndarray | None) -> np.ndarray:
    """The same for texts in order of size, the largest first."""
    total, stage = np.zeros(len(sizes)), 2 * LEVELS
    weights = np.tile(mixer.weights.astype("f4"), (1, len(sizes)))  # inputs x (text, gate)
    past_ones, past = np.tile(mixer.ones, len(sizes)), np.tile(mixer.n, len(sizes))
    for a in range(0, int(sizes[0]), CHUNK):
        lanes = int(np.searchsorted(-sizes, -a, side="left"))
        n = np.minimum(sizes[:lanes] - a, CHUNK)
        first = np.cumsum(n) - n
        lane = np.repeat(np.arange(lanes), n)
        at = np.arange(len(lane)) + np.repeat(starts[:lanes] + a - first, n)
        gate, yes, no = flags.gate[at], flags.yes[at], flags.no[at]
        key = lane * FLAG_GATES + gate
        x = flags.inputs[:, at]
        z = np.einsum("ke,ke->e", x, weights[:, key])
        np.clip(z, -16, 16, out=z)
        p = 1 / (1 + np.exp(-z))
        cell = lane * stage + (gate >= RUN_GATES) * LEVELS + level_of(z)
        refined = 0.5 * p + 0.5 * (past_ones[cell] / past[cell])
        taken = refined * yes
        whole = taken + (1 - refined) * no
        total[:lanes] += np.add.reduceat(np.log(whole), first)
        way = taken / whole  # how likely the flag was set, given what follows
        x *= (way - p).astype("f4")
        step = np.stack([np.bincount(key, weights=row, minlength=lanes * FLAG_GATES) for row in x])
        weights[:, : lanes * FLAG_GATES] += (RATE * step).astype("f4")
        past_ones[: lanes * stage] += (ones := np.bincount(cell, weights=way, minlength=lanes * stage))
        past[: lanes * stage] += (seen := np.bincount(cell, minlength=lanes * stage))
        if squares is not None:
            step = step.reshape(INPUTS, lanes, FLAG_GATES).sum(axis=1)
            squares += step * step
            move = 0.05 * step / np.sqrt(squares)
            mixer.weights += move
            weights += np.tile(move.astype("f4"), (1, len(sizes)))
            mixer.ones += ones.reshape(lanes, -1).sum(axis=0)
            mixer.n += seen.reshape(lanes, -1).sum(axis=0)
    return total


def sums_of(terms: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each text's terms, in whole units of 2^-34, so that equal texts get equal sums wherever they stand."""
    sums = np.concatenate([[0], np.cumsum(np.rint(terms * UNITS).astype("i8"))])
    return (sums[first[1:]] - sums[first[:-1]]) / UNITS


def score_block(words: list[bytes], seq: np.ndarray, known: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """The natural log probability of each of a block's texts."""
    spelling = np.zeros(len(seq))
    spelled = (known <= 0) | (known & 1 == 0)
    needed, which = distinct(seq[spelled])
    spelling[spelled] = model.spelled([words[k] for k in needed.tolist()])[which]
    out = sums_of(spelling, first)
    groups = np.unique(np.searchsorted(first, np.arange(0, first[-1], 2 * ENTRIES), side="left"))
    for i, j in zip(groups.tolist(), [*groups[1:].tolist(), len(first) - 1]):
        a, b = first[i], first[j]
        if b > a:
            out[i:j] += mix(flags_of(seq[a:b], known[a:b], first[i : j + 1] - a, spelling[a:b]), model.flags)
    return out


# --- words and continuations over the corpus

BLOCKS = "block string, doc_id array<long>, held array<int>, tune array<int>, first array<int>, seq binary, spelled binary, counts binary"


def packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers of several arrays of one length, byte plane by byte plane: small and sorted ones take little room, and planes
    that they do not need are left out. The first numbers stand apart, as those of steps may be large."""
    head, planes = [struct.pack("<q", len(arrays[0]))], []
    for a in arrays:
        a = a.astype("<i8")
        first = int(a[0]) if len(a) else 0
        a[:1] = 0
        width = (int(a.max(initial=0)).bit_length() + 7) // 8 if a.min(initial=0) >= 0 else 8
        head.append(struct.pack("<qB", first, width))
        planes.append(np.ascontiguousarray(a.view("u1").reshape(-1, 8)[:, :width].T).tobytes())
    return b"".join(head) + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(raw: bytes, arrays: int) -> list[np.ndarray]:
    (n,), at, out = struct.unpack_from("<q", raw), 8 + 9 * arrays, []
    planes, k = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[at:]), "u1"), 0
    for j in range(arrays):
        first, width = struct.unpack_from("<qB", raw, 8 + 9 * j)
        own = np.zeros((n, 8), "u1")
        own[:, :width] = planes[k : k + width * n].reshape(width, n).T
        own = own.view("<i8").reshape(-1)
        own[:1] = first
        out.append(own)
        k += width * n
    return out


def rises(sorted_keys: np.ndarray, low: int = 0) -> np.ndarray:
    return (np.diff(sorted_keys, prepend=np.uint64(0)) >> np.uint64(low)).view("i8")


def risen(steps: np.ndarray, low: int = 0) -> np.ndarray:
    return np.cumsum(steps.view("u8"), dtype="u8") << np.uint64(low)


def spelled_words(raw: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(raw).split(b" ")


def digests(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first 64 and the next 8 bits of each word's 128-bit hash, and the words' order by both."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").reshape(-1, 2)
    high, low = both[:, 0].astype("u8"), both[:, 1].astype("u8") >> np.uint64(56)
    order = np.argsort(high)
    return high, low, order if (np.diff(high[order]) > 0).all() else np.lexsort((low, high))


def one_list(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def parts_of(text: str):
    """The text's bytes in stretches that end at blanks, so that lists of words do not follow its length."""
    raw, a = text.encode().lower(), 0
    while len(raw) - a > STRETCH and (b := raw.find(b" ", a + STRETCH)) >= 0:
        yield raw[a:b]
        a = b
    yield raw[a:]


class Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def word_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of texts as numbers of their dictionary's words: the commonest first and the rare ones in order, with their counts
    in training texts, and in the training texts that tune the mixer."""

    def block(ids, held, tune, seqs, numbers):
        words, seq = list(numbers), np.concatenate(seqs)
        times = np.bincount(seq, minlength=len(words))  # common words have small numbers, which take less room; the others stand in order, for the same reason
        order = np.concatenate([(often := np.flatnonzero(times > RARE))[np.argsort(-times[often], kind="stable")], sorted(np.flatnonzero(times <= RARE).tolist(), key=words.__getitem__)]).astype("i8")
        rank = np.empty(len(words), "i4")
        rank[order] = np.arange(len(words))
        seq = rank[seq]
        first = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
        learn = np.repeat(~np.array(held), np.diff(first))
        counts = [np.bincount(seq[m], minlength=len(words)) for m in (learn, learn & np.repeat(np.array(tune), np.diff(first)))]
        spelled = zstandard.ZstdCompressor(level=6).compress(b" ".join(words[k] for k in order.tolist()))
        lists = [one_list(np.array(v, "i4")) for v in (held, tune, first)]
        binaries = [pa.array([x], pa.binary()) for x in (packed(seq), spelled, packed(*counts))]
        return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([ids], pa.list_(pa.int64())), *lists, *binaries], [x.split()[0] for x in BLOCKS.split(", ")])

    def run(batches):
        ids, held, tune, seqs, numbers, size = [], [], [], [], Numbers({END: 0}), 0
        for batch in batches:
            for doc_id, out, draw, value in zip(batch["doc_id"].to_pylist(), batch["held"].to_pylist(), batch["tune"].to_pylist(), batch["text"]):
                text = value.as_py() or ""
                own = [np.fromiter(map(numbers.__getitem__, words), "i4", len(words)) for words in map(bytes.split, parts_of(text))]
                ids.append(doc_id)
                held.append(out)
                tune.append(draw and not out)
                seqs.append(np.concatenate([*own, [0]]).astype("i4"))
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield block(ids, held, tune, seqs, numbers)
                    ids, held, tune, seqs, numbers, size = [], [], [], [], Numbers({END: 0}), 0
        if ids:
            yield block(ids, held, tune, seqs, numbers)

    return docs.select("doc_id", "held", "tune", "text").mapInArrow(run, BLOCKS)


def numbered(column: pa.ChunkedArray | pa.Array, k: int = 0) -> np.ndarray:
    return column[k].values.to_numpy(zero_copy_only=False)


KEY_BITS = 32  # of the two words before a word, at least
NEXT = 11  # bits that tell continuations of the same words apart


def continuations(seq: np.ndarray, first: np.ndarray, high: np.ndarray, bits: int) -> np.ndarray:
    """A key for each word of a block's texts: ``bits`` bits of the two words before, NEXT bits of the word, then zeros."""
    h = high[seq]
    place = np.arange(len(seq)) - np.repeat(first[:-1], np.diff(first))
    one, two = np.zeros(len(seq), "u8"), np.zeros(len(seq), "u8")
    one[1:], two[2:] = h[:-1], h[:-2]
    one[place < 1], two[place < 2] = 0, 0
    key = mixed(mixed(two ^ np.uint64(0x9E3779B97F4A7C15)) + one)
    key ^= key >> np.uint64(29)
    low = np.uint64(64 - bits)
    return (key * np.uint64(0x9E3779B97F4A7C15) >> low) << low | h >> np.uint64(64 - NEXT) << np.uint64(64 - bits - NEXT)


SPREAD = "block string, part int, words binary, pairs binary"
JOINED = "doc_id array<long>, held array<int>, tune array<int>, first array<int>, seq binary, spelled binary, counts binary, known binary"


def joined_blocks(blocks: DataFrame, bits: int, key_bits: int) -> DataFrame:
    """JOINED: blocks with what the corpus knows of their words (counts: how often they occur in training texts, times two, and
    one more in the one block that speaks for a word, and there how often in those that tune) and of their continuations.

    Words and continuations go by the first ``bits`` of their hashes to the tasks that add them up, one entry of each
    block that has them, so frequent ones weigh no more than rare ones; the sums come back to the blocks. Two words before
    are told apart by ``key_bits`` bits.
    """
    low_bits = 64 - key_bits - NEXT

    def split(batches):
        part_of = lambda h: (h >> np.uint64(64 - bits)).astype("i8") if bits else np.zeros(len(h), "i8")
        for batch in batches:
            for k in range(batch.num_rows):
                high, low, order = digests(spelled_words(batch["spelled"][k].as_py()))
                (seq,), (train, tuned) = unpacked(batch["seq"][k].as_py(), 1), unpacked(batch["counts"][k].as_py(), 2)
                first, held = numbered(batch["first"], k), numbered(batch["held"], k)
                keys, where = distinct(continuations(seq, first, high, key_bits))
                times = np.bincount(where[np.repeat(held == 0, np.diff(first))], minlength=len(keys))
                high, low, train, tuned = high[order], low[order], train[order], tuned[order]
                words_in, keys_in = part_of(high), part_of(keys)
                parts = np.union1d(words_in, keys_in)
                spans = [np.append(np.searchsorted(x, parts), len(x)).tolist() for x in (words_in, keys_in)]
                for a in range(0, len(parts), 512):
                    rows = range(a, min(a + 512, len(parts)))
                    words = [packed(rises(high[c:d]), low[c:d], train[c:d], tuned[c:d]) for c, d in ((spans[0][j], spans[0][j + 1]) for j in rows)]
                    pairs = [packed(rises(keys[c:d], low_bits), times[c:d]) for c, d in ((spans[1][j], spans[1][j + 1]) for j in rows)]
                    yield pa.RecordBatch.from_arrays([pa.array([batch["block"][k].as_py()] * len(rows)), pa.array(parts[a : a + 512].astype("i4")), pa.array(words, pa.binary()), pa.array(pairs, pa.binary())], [x.split()[0] for x in SPREAD.split(", ")])

    def add(table: pa.Table) -> pa.Table:
        words, pairs = [unpacked(x.as_py(), 4) for x in table["words"]], [unpacked(x.as_py(), 2) for x in table["pairs"]]
        high, (low, train, tuned) = np.concatenate([risen(w[0]) for w in words]), (np.concatenate([w[j] for w in words]) for j in (1, 2, 3))
        order = np.argsort(high)
        if (same := high[order][1:] == high[order][:-1]).any() and (same & (low[order][1:] != low[order][:-1])).any():
            order = np.lexsort((low, high))
        new = np.concatenate([[True], (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])])[: len(order)]
        word = np.empty(len(order), "i8")
        word[order] = np.cumsum(new) - 1
        counts, tuned = (np.bincount(word, weights=x).astype("i8") for x in (train, tuned))
        speaks = np.zeros(len(order), bool)
        speaks[order[new]] = True  # one block speaks for each word
        n, tuned = counts[word] << 1 | speaks, np.where(speaks, tuned[word], 0)
        keys, where = distinct(np.concatenate([risen(p[0], low_bits) for p in pairs]))
        times = np.bincount(where, weights=np.concatenate([p[1] for p in pairs])).astype("i8")
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] >> np.uint64(64 - key_bits) != keys[:-1] >> np.uint64(64 - key_bits)]))[: len(keys)]
        size = np.diff(np.append(begins, len(keys)))
        all_, most = (np.repeat(f.reduceat(times, begins), size) if len(keys) else times for f in (np.add, np.maximum))
        best = np.flatnonzero(times == most)
        leads = np.zeros(len(keys), bool)
        leads[best[np.unique(np.repeat(begins, size)[best], return_index=True)[1]]] = True  # of equal ones the first
        back = [np.split(x, np.cumsum([len(w[0]) for w in words])[:-1]) for x in (n, tuned)] + [np.split(x[where], np.cumsum([len(p[0]) for p in pairs])[:-1]) for x in (all_, most << 1 | leads)]
        columns = {"words": [packed(*x) for x in zip(*back[:2])], "pairs": [packed(*x) for x in zip(*back[2:])]}
        return pa.table({"block": table["block"], "part": table["part"]} | {c: pa.array(v, pa.binary()) for c, v in columns.items()})

    def join(own: pa.Table, found: pa.Table) -> pa.Table:
        by_part = np.argsort(found["part"].to_numpy(), kind="stable").tolist()
        (n, tuned), (all_, most) = ([np.concatenate(x) for x in zip(*(unpacked(found[c][k].as_py(), 2) for k in by_part))] for c in ("words", "pairs"))
        (seq,) = unpacked(own["seq"][0].as_py(), 1)
        high, _, order = digests(spelled_words(own["spelled"][0].as_py()))
        back = np.empty((2, len(order)), "i8")
        back[:, order] = n, tuned
        n, tuned = back
        known = others(seq, numbered(own["first"]), high, numbered(own["held"]) == 0, all_, most >> 1, most & 1, key_bits)
        more = {"counts": packed(n, tuned), "known": packed(known)}
        return pa.table({c: own[c] for c in ("doc_id", "held", "tune", "first", "seq", "spelled")} | {c: pa.array([v], pa.binary()) for c, v in more.items()})

    spread = blocks.mapInArrow(split, SPREAD)
    sums = spread.groupBy("part").applyInArrow(add, SPREAD)
    return blocks.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(join, JOINED)


def others(seq: np.ndarray, first: np.ndarray, high: np.ndarray, learn: np.ndarray, all_: np.ndarray, most: np.ndarray, leads: np.ndarray, bits: int) -> np.ndarray:
    """For each word of a block's texts, what other texts know of the two words before: how often they had them (from bit 16),
    how often their commonest continuation (15 bits), and whether that comes here; 0 if they know none. Counts are halved
    together where they need more bits."""
    keys, where = distinct(continuations(seq, first, high, bits))
    before = np.cumsum(np.concatenate([[False], keys[1:] >> np.uint64(64 - bits) != keys[:-1] >> np.uint64(64 - bits)])[: len(keys)])
    all_, most, leads = all_[where], most[where], leads[where]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    own, at = distinct(text * max(1, len(keys)) + before[where])
    out = learn[text]
    all_ = all_ - np.where(out, np.bincount(at, minlength=len(own))[at], 0)
    most = most - np.where(out, np.bincount(at, weights=leads, minlength=len(own)).astype("i8")[at], 0)
    shift = np.zeros(len(seq), "i8")
    big = all_ > 0x7FFF
    shift[big] = np.ceil(np.log2((all_[big] + 1) / 0x8000)).astype("i8")
    return np.where(most > 0, np.maximum(all_ >> shift, 1) << 16 | np.maximum(most >> shift, 1) << 1 | leads, 0).astype("i4")


def runs_of(known: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many continuations came true in a row before each word of each text."""
    hit = (known > 0) & (known & 1 == 1)
    at = np.arange(len(known))
    miss = np.where(hit, -1, at)
    begin = np.repeat(first[:-1], np.diff(first))
    before = np.concatenate([[-1], np.maximum.accumulate(miss)[:-1]]) if len(miss) else miss
    return at - 1 - np.maximum(before, begin - 1)


# --- training and scoring


def row_of(batch: pa.RecordBatch, k: int, *names: str) -> list[np.ndarray]:
    """Columns of a row of JOINED as arrays; counts are two, and one after the other."""
    out = []
    for c in names:
        out += unpacked(batch[c][k].as_py(), 2 if c == "counts" else 1) if c in ("seq", "counts", "known") else [numbered(batch[c], k)]
    return out


def spoken(batch: pa.RecordBatch, k: int) -> tuple[list[bytes], np.ndarray]:
    """The training words that a block speaks for, with their counts in all training texts, and in those that do not tune."""
    n, tuned = row_of(batch, k, "counts")
    some = np.flatnonzero((n > 1) & (n & 1 == 1))
    n = n >> 1
    words = spelled_words(batch["spelled"][k].as_py())
    return [words[j] for j in some.tolist()], np.stack([n[some], n[some] - tuned[some]], axis=1)


def byte_pairs(joined: DataFrame) -> tuple[np.ndarray, int, int]:
    """How often each byte follows each byte in the spelling of all training words; the number of words, and of distinct ones."""

    def run(batches):
        total = np.zeros((1 << 16) + 2, "i8")
        for batch in batches:
            for k in range(batch.num_rows):
                words, counts = spoken(batch, k)
                total[-2:] += counts[:, 0].sum(), len(words)
                for some, times in in_stretches(words, counts[:, 0], ENTRIES):
                    parts = [b" " + (w if w == END else w + b" ") for w in some]
                    line = np.frombuffer(b"".join(parts), "u1").astype("i8")
                    sizes = np.fromiter(map(len, parts), "i8", len(parts))
                    inside = np.ones(len(line), bool)
                    inside[np.cumsum(sizes) - sizes] = False
                    at = np.flatnonzero(inside)
                    total[:-2] += np.bincount(line[at - 1] * 256 + line[at], weights=np.repeat(times, sizes - 1), minlength=1 << 16).astype("i8")
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype("i4")), pa.array(total[used])], ["pair", "n"])

    out = np.zeros((1 << 16) + 2, "i8")
    for r in joined.select("spelled", "counts").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # 65,538 rows at most
        out[r["pair"]] = r["n"]
    return out[:-2].reshape(256, 256), int(out[-2]), int(out[-1])


def spelling_tables(spark: SparkSession, joined: DataFrame, trees: Trees, bits: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Packed logits of all tables from all training words, and from those of the texts that do not tune."""
    shared = spark.sparkContext.broadcast(trees)

    width = (64 - int(2 * offsets_of(bits)[-1]).bit_length()) // 2

    def count(batches):
        held, size = defaultdict(list), 0
        for batch in batches:
            for k in range(batch.num_rows):
                for keys, sums in counted(*spoken(batch, k), shared.value, bits):
                    for shift, entries in narrow(keys, sums, width):
                        held[shift].append(entries)
                    size += len(keys)
                    if size >= COUNTED:
                        yield from packed_counts(held, width)
                        size = 0
        yield from packed_counts(held, width)

    def add(batches):
        at, own = None, np.zeros((2, 2 << PART), "i8")
        made = lambda n: pa.array([packed_logits(n[::2], n[1::2]).tobytes()], pa.binary())
        done = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), made(own[0]), made(own[0] - own[1])], ["part", "every", "some"])
        for batch in batches:
            for part, raw in zip(batch["part"].to_pylist(), batch["packed"]):
                if part != at:
                    if at is not None:
                        yield done()
                    at = part
                    own[:] = 0
                step, n, less = unpacked(raw.as_py(), 3)
                place = np.cumsum(step)
                own[0, place] += n
                own[1, place] += less
        if at is not None:
            yield done()

    tables = np.full((2, int(offsets_of(bits)[-1])), UNSEEN, "u1")
    packed = joined.select("spelled", "counts").mapInArrow(count, "part int, packed binary")
    made = packed.repartition("part").sortWithinPartitions("part").mapInArrow(add, "part int, every binary, some binary").toArrow()
    for name, out in zip(("every", "some"), tables):
        for part, own in zip(made["part"].to_pylist(), made[name]):
            out[part << PART : (part + 1) << PART] = np.frombuffer(own.as_buffer(), "u1")[: len(out) - (part << PART)]
    shared.destroy()
    return tables[0], tables[1]


def narrow(keys: np.ndarray, sums: np.ndarray, width: int):
    """(shift, entries) of keys and their two counts: an entry is a key, ``width`` bits of its count from ``shift`` on, and as many of
    what the second count is less by, in one number. Counts that need more bits have further entries, by the next shift."""
    keys, (n, less), shift, low = keys.astype("u8"), np.stack([sums[0], sums[0] - sums[1]]).astype("u8"), 0, np.uint64((1 << width) - 1)
    while len(keys):
        yield shift, (keys << np.uint64(width) | n & low) << np.uint64(width) | less & low
        more = n > low
        keys, n, less = keys[more], n[more] >> np.uint64(width), less[more] >> np.uint64(width)
        shift += width


def packed_counts(held: dict[int, list[np.ndarray]], width: int):
    """Batches (part, packed) of the sums of entries by shift, which are taken out of ``held``: keys in steps, counts, and what the
    second ones are less by. Entries are sorted where they stand, and added up part by part: a second copy of them all is not made."""
    step, low = np.uint64(2 * width + PART + 1), np.uint64((1 << width) - 1)
    for shift in list(held):
        entries = np.concatenate(held.pop(shift))
        entries.sort()
        edges = np.searchsorted(entries, np.arange(int(entries[-1] >> step) + 1, dtype="u8") << step)
        edges = np.append(edges, len(entries))
        parts = np.flatnonzero(np.diff(edges))
        for k in range(0, len(parts), 64):
            rows = []
            for a, b in zip(edges[parts[k : k + 64]].tolist(), edges[parts[k : k + 64] + 1].tolist()):
                at = (entries[a:b] >> np.uint64(2 * width) & np.uint64((2 << PART) - 1)).astype("i8")
                first = np.flatnonzero(np.diff(at, prepend=-1))
                n, less = (np.add.reduceat(entries[a:b] >> np.uint64(w) & low, first) << np.uint64(shift) for w in (width, 0))
                rows.append(packed(np.diff(at[first], prepend=0), n, less))
            yield pa.RecordBatch.from_arrays([pa.array(parts[k : k + 64].astype("i4")), pa.array(rows, pa.binary())], ["part", "packed"])


def chosen(texts: np.ndarray, seq: np.ndarray, known: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seq, known, first) of some of a block's texts."""
    at = np.concatenate([np.zeros(0, "i8"), *(np.arange(first[k], first[k + 1]) for k in texts.tolist())]).astype("i8")
    return seq[at], known[at], np.concatenate([[0], np.cumsum(np.diff(first)[texts])])


def lesson(words: list[bytes], seq: np.ndarray, known: np.ndarray, first: np.ndarray, model: Model) -> list[np.ndarray]:
    """What some texts teach: for the spelling and the flags, moved weights times how much they count, that, and the last
    stage's new ones and bits."""
    spelled, spelling, out = (known <= 0) | (known & 1 == 0), np.zeros(len(seq)), []
    for m, new in ((Mixer.spelling(), Mixer.spelling()), (Mixer.flags(), Mixer.flags())):
        squares = np.full(m.weights.shape, 1e-3)
        if not out:
            spelling[spelled] = Model(model.trees, model.bits, model.table, m, m).spelled([words[k] for k in seq[spelled].tolist()], squares)
        else:
            mix(flags_of(seq, known, first, spelling), m, squares)
        counts = (squares > 2e-3).any(axis=0) * (m.n - new.n).sum()
        out += [(m.weights * counts).reshape(-1), counts, m.ones - new.ones, m.n - new.n]
    return out


def tuned(spark: SparkSession, joined: DataFrame, model: Model) -> tuple[Mixer, Mixer]:
    """The mixers of spelling and flags after the texts that tune them: each block learns from its own, and what they learned is
    averaged by their bits, in exact sums."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        total = None
        for batch in batches:
            for k in range(batch.num_rows):
                tune, seq, known, first = row_of(batch, k, "tune", "seq", "known", "first")
                some = np.flatnonzero(tune)
                if len(some):
                    own = np.concatenate(lesson(spelled_words(batch["spelled"][k].as_py()), *chosen(some, seq, known, first), shared.value))
                    total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype="i4")), pa.array(total)], ["k", "v"])

    rows = joined.select("tune", "seq", "known", "first", "spelled").mapInArrow(run, "k int, v double")
    found = {r["k"]: float(r["v"]) for r in rows.groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,9)")).alias("v")).collect()}  # some thousand numbers
    shared.destroy()
    out, at = [], 0
    for mixer in (Mixer.spelling(), Mixer.flags()):
        sizes = (mixer.weights.size, mixer.weights.shape[1], len(mixer.ones), len(mixer.n))
        total, counts, ones, n = (np.array([found.get(k, 0.0) for k in range(a, a + size)]) for a, size in zip(at + np.cumsum([0, *sizes[:-1]]), sizes))
        at += sum(sizes)
        weights = np.where(counts > 0, total.reshape(mixer.weights.shape) / np.maximum(counts, 1e-9), mixer.weights)
        out.append(Mixer(weights, mixer.ones + ones, mixer.n + n).steady())
    return out[0], out[1]


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"


def score_documents(spark: SparkSession, docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row of ``docs``."""
    tune = F.pmod(F.xxhash64(F.lit("tune"), F.col("doc_id").cast("string"), "text"), F.lit(TUNE_PARTS)) == 0
    rows = docs.select(F.col("doc_id").cast("long"), "text", held_out.alias("held"), tune.alias("tune"))
    with scratch(spark):  # the blocks go when they are joined
        blocks = materialize(spark, word_blocks(rows), "blocks")
        entries = blocks.agg(F.sum(F.element_at("first", -1).cast("long"))).first()[0] or 0
        key_bits = min(64 - NEXT, max(KEY_BITS, entries.bit_length() + 5))  # of two words before: over thirty times as many keys as there are words
        joined = materialize(spark, joined_blocks(blocks, max(0, (entries // PART_ENTRIES).bit_length()), key_bits), "joined")
    pairs, n, v = byte_pairs(joined)
    trees, bits = trees_of(pairs), table_bits(v)
    every, some = spelling_tables(spark, joined, trees, bits)
    mixers = tuned(spark, joined, Model(trees, bits, some, Mixer.spelling(), Mixer.flags()))
    shared = spark.sparkContext.broadcast(Model(trees, bits, every, *mixers))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                held, seq, known, first, c, _ = row_of(batch, k, "held", "seq", "known", "first", "counts")
                words = spelled_words(batch["spelled"][k].as_py())
                c = c >> 1
                logs = (np.log10(c + 1.0) - math.log10(n + v + 1))[seq]
                known_words = np.concatenate([[0], np.cumsum(c[seq] > 0)])
                lengths = np.fromiter(map(len, words), "i8", len(words)) + 1
                lengths[words.index(END)] = 1
                size = np.concatenate([[0], np.cumsum(lengths[seq])])
                score = score_block(words, seq, known, first, shared.value)
                base = sums_of(logs, first)
                columns = [pa.array(held == 1), pa.array(np.diff(first).astype("i8")), pa.array(np.diff(known_words[first])), pa.array(base), pa.array(score / math.log(10)), pa.array(-score / math.log(2) / np.diff(size[first]))]
                yield pa.RecordBatch.from_arrays([batch["doc_id"][k].values, *columns], [x.split()[0] for x in SCORES.split(", ")])

    scored = joined.select("doc_id", "held", "seq", "known", "first", "spelled", "counts").mapInArrow(run, SCORES)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")


def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark, load(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) == 2)
