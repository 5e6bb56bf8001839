"""Language-model scores by logistic context mixing.

A text is the sequence of its words and one end. Every word is spelled as bytes and a space, the end as a newline, and every bit of the spelling is predicted: each
of several hashed contexts (the last bytes of the word, all of it so far, and both together with the state of the text) gives a prediction from the bits
seen after it in the training words; a gate picked by place in the byte and in the word, and by how well the context is known, weighs them in the logistic domain; a
last table refines the mixed probability by how it has fared. The state of a text is the cluster (of letter frequencies) its first words fall in; it is
known only after them, so every word is predicted from what stands before it. What followed the same two words in the training texts is mixed in last: the counts of a pair's
successors, less a discount, and the discounts' mass for the spelled probability. So every token has a proper probability given what stands before it, and the product over tokens is one of the text; its negative
logarithm per byte is ``bits_per_byte``.

Spark gathers the words of all training texts; the contexts' bit counts cover all of them, each word by its count. Weights and refinement
learn online from all of them too, piece by piece, each word's own occurrence taken out of the counts first; the pieces' weights are averaged. Afterwards the model is
fixed, so scores do not depend on the order of rows. Spelling depends on the word and the state, so each distinct word is spelled once per state: runs of documents ask for their distinct words by one join, which comes
back per run. Runs also send their distinct word triples, as sorted hashes by pieces of the hash range; all triples that begin with one pair meet in one piece, which counts them over all training texts and answers every run.

Defined results: a null or empty text is the end alone; without training texts N is 0, no token is known and the model is uniform; repeated rows count
and repeat; a null id is in the fold of the empty text; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import WORD, crc_fold, mix64, narrow, parts_for, text_runs
from riskloom.llm.training import sigmoid
from riskloom.session import materialize

RUN_BYTES = 16 << 20  # texts of one run of documents, about
RUN_WORDS = 500_000  # distinct words after which a run ends
WORDS_PER_ROW = 20_000
CONTEXTS = ((1, False), (2, False), (3, False), (4, False), (0, False), (2, True), (4, True), (0, True))  # bytes of context (0: the whole word so far), with the state
TABLE_BITS = (16, 19, 20, 20, 21, 20, 20, 21)
STATES = 8  # state 0: not known yet
STATE_AFTER = (4, 20)  # words after which the state is taken anew
STATE_ROUNDS = 12  # rounds of k-means over all training texts
PIECE_WORDS = 250_000  # distinct words of a piece, about; pieces learn side by side
CHUNK_WORDS = 4_096  # spelled at a time
STREAM_WORDS = 60_000  # a vocabulary of fewer distinct words is gone through several times
MOST = 4e9  # larger bit counts tell no more
LEAST = 2.0**-16  # smallest probability of a bit

PIECES = 1_024  # of the hashes of word triples
TRIPLES_PER_GROUP = 1_000_000  # of pieces that are counted together, about
WORD_BITS, PAIR_BITS, NEXT_BITS = 40, 40, 16  # of hashes: a word, two words, and the word after them

_OFFSETS = np.concatenate([[0], np.cumsum([1 << b for b in TABLE_BITS])]).astype(np.int64)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PLACES, _TRUST = 4 * 8, 6
_GATES = _PLACES * _TRUST
_WHOLE = CONTEXTS.index((0, True))
_WHOLE_SHARE = 60_000.0


def held_out(doc_id: Column) -> Column:
    return crc_fold(doc_id, 5) == 1


# ---- spelling and contexts ---------------------------------------------------------------------------------------------------------


@dataclass
class Spelled:
    """Bits of a list of words: table slots per context, the bits, the place of each; and per byte of all words its word and its place among the bytes spelled."""

    slots: np.ndarray  # contexts x bits
    bits: np.ndarray
    places: np.ndarray
    states: np.ndarray  # bits of the byte so far
    words: np.ndarray
    n_words: int
    spelled: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], once: bool = False) -> Spelled:
        """Words begin with the byte of their state and end in their terminator (space, or the newline that is the end).

        ``once``: bytes after the same state and beginning of a word are spelled once, as all contexts agree there.
        """
        state = np.fromiter((w[0] for w in words), dtype=np.uint64, count=len(words))
        words = [w[1:] for w in words]
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        place, spelled = np.arange(len(text)) - first, np.arange(len(text))
        with np.errstate(over="ignore"):
            text_state = state[word]
            back = [np.zeros(len(text), dtype=np.uint64) for _ in range(4)]  # bytes before, plus 1; 0 before the word
            for d, column in enumerate(back, start=1):
                column[d:] = np.where(place[d:] >= d, text[:-d].astype(np.uint64) + np.uint64(1), np.uint64(0))
            whole = _prefix_hashes(text, first)
            if once:
                begin = mix64(whole + (text_state * np.uint64(0x9E3779B97F4A7C15))) + (place.astype(np.uint64) << np.uint64(8)) + text
                _, pick, spelled = np.unique(mix64(begin), return_index=True, return_inverse=True)
                text, place, text_state, whole, back = text[pick], place[pick], text_state[pick], whole[pick], [column[pick] for column in back]
            # bytes so far: bit j of a byte is predicted from the node 1 b7 .. of the bits above it
            nodes = np.stack([(1 << j) | (text.astype(np.int64) >> (8 - j)) for j in range(8)], axis=1)
            slots = np.empty((len(CONTEXTS), len(text) * 8), dtype=np.int32)
            spread_nodes = nodes.astype(np.uint64) * np.uint64(0x9E6C63D0876A9A47)
            at = np.empty_like(spread_nodes)
            for i, ((order, with_state), bits) in enumerate(zip(CONTEXTS, TABLE_BITS)):
                context = whole if order == 0 else np.zeros(len(text), dtype=np.uint64)
                for column in back[:order]:
                    context = context * np.uint64(0x9E3779B97F4A7C15) + column + np.uint64(1)
                if with_state:
                    context = mix64(context + (text_state + np.uint64(1)) * np.uint64(0xBB67AE8584CAA73B))
                if order == 1:
                    at[:] = (np.maximum(back[0].astype(np.int64) - 1, 0)[:, None] << 8) | nodes
                else:
                    seeds = mix64(context + np.uint64((i + 1) * 0x1F3D5B79))
                    np.bitwise_xor(seeds[:, None], spread_nodes, out=at)
                    at *= np.uint64(0xD6E8FEB86659FD93)
                    at >>= np.uint64(64 - bits)
                slots[i] = at.reshape(-1)
                slots[i] += np.int32(_OFFSETS[i])
        values = ((text[:, None] >> np.arange(7, -1, -1, dtype=np.uint8)) & 1).astype(np.uint8).reshape(-1)
        places = (np.minimum(place, 3)[:, None] * 8 + np.arange(8)).reshape(-1)
        return cls(slots, values, places, nodes.reshape(-1), word, len(words), spelled)


def _prefix_hashes(text: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each word's start up to, without, each place: unlike prefixes differ, like ones agree wherever they stand."""
    base = 0x2545F4914F6CDD1D
    n = len(text)
    up, down = np.full(n + 1, base, dtype=np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return (sums[:n] - sums[first]) * down[first]


def stretch(p):
    return np.log(p / (1 - p))


# ---- the model ---------------------------------------------------------------------------------------------------------------------


@dataclass
class MixingModel:
    """Stretched predictions of all context slots, how often the whole-word ones were seen (in levels), weights per gate, and the refinement table
    (bits so far x levels of the mixed value)."""

    table: np.ndarray
    trust: np.ndarray
    weights: np.ndarray
    refined: np.ndarray

    @classmethod
    def of(cls, zeros: np.ndarray, ones: np.ndarray, weights: np.ndarray, refined: np.ndarray) -> MixingModel:
        return cls(_predictions(zeros, ones).astype(np.float32), _trust((zeros + ones)[_OFFSETS[_WHOLE]:]), weights, refined)

    def log10(self, words: list[bytes]) -> np.ndarray:
        """Decimal logarithm of the probability of each spelled word."""
        out, columns = [], np.ascontiguousarray(self.weights.T)
        for start in range(0, len(words), CHUNK_WORDS):
            s = Spelled.of(words[start:start + CHUNK_WORDS], once=True)
            gates = self.trust[s.slots[_WHOLE] - _OFFSETS[_WHOLE]] * np.int64(_PLACES) + s.places
            z = columns[-1].take(gates)
            for column, slots in zip(columns, s.slots):
                z += column.take(gates) * self.table.take(slots)
            p = self._refine(z, s.states)
            of_byte = np.log10(np.where(s.bits == 1, p, 1 - p)).reshape(-1, 8).sum(axis=1)
            out.append(np.bincount(s.words, weights=of_byte[s.spelled], minlength=s.n_words))
        return np.concatenate(out) if out else np.empty(0)

    def _refine(self, z: np.ndarray, states: np.ndarray) -> np.ndarray:
        return np.clip((sigmoid(z) + self.refined[states, _level(z)]) / 2, LEAST, 1 - LEAST)


_LEVELS = 24


def _trust(n: np.ndarray) -> np.ndarray:
    """Level of a count: never, once or twice, to 7, to 31, to 255, more."""
    return np.searchsorted(np.array([0.5, 2.5, 7.5, 31.5, 255.5]), n).astype(np.int8)


def _level(z: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(z + _LEVELS / 2), 0, _LEVELS - 1).astype(np.int64)


def bit_counts(words: list[bytes], times: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> None:
    """Add the bits of spelled words, each ``times``, to the counts of all contexts."""
    for start in range(0, len(words), CHUNK_WORDS):
        s = Spelled.of(words[start:start + CHUNK_WORDS], once=True)
        weight = np.repeat(np.bincount(s.spelled, weights=times[start:start + CHUNK_WORDS][s.words]).astype(np.float32), 8)
        for bit, table in ((0, zeros), (1, ones)):
            pick = np.flatnonzero(s.bits == bit)
            picked = weight.take(pick)
            for slots in s.slots:
                np.add.at(table, slots.take(pick), picked)


def _predictions(zeros, ones):
    return stretch(np.clip((ones + 0.2) / (zeros + ones + 0.4), 1e-6, 1 - 1e-6))


class Sent:
    """A value that tasks build from the bit counts, once per worker. Counts travel compressed: every executor keeps a broadcast on its disk."""

    def __init__(self, build: Callable, zeros: np.ndarray, ones: np.ndarray, *more: np.ndarray):
        self.build, self.more, self.counts = build, more, [squeeze(np.minimum(t, MOST)) for t in (zeros, ones)]

    @cached_property
    def built(self):
        return self.build(*[expand(t).astype(np.float32) for t in self.counts], *self.more)


@dataclass
class Inputs:
    """What the contexts say of a bit, by slot and bit, from counts that lack this occurrence: stretched predictions, and levels of the whole-word slots."""

    stretched: np.ndarray
    trust: np.ndarray

    @classmethod
    def of(cls, zeros: np.ndarray, ones: np.ndarray) -> Inputs:
        out = cls(np.empty(2 * len(zeros), dtype=np.float32), np.empty(2 << TABLE_BITS[_WHOLE], dtype=np.int8))
        for bit in (0, 1):
            for a in range(0, len(zeros), 1 << 16):
                n0, n1 = (np.maximum(t[a:a + (1 << 16)] - np.float32(b == bit), 0) for b, t in enumerate((zeros, ones)))
                p = (n1 + np.float32(0.2)) / (n0 + n1 + np.float32(0.4))
                out.stretched[2 * a + bit:2 * (a + len(p)):2] = stretch(np.clip(p, np.float32(1e-6), np.float32(1 - 1e-6)))
                if a >= _OFFSETS[_WHOLE]:
                    b = 2 * (a - _OFFSETS[_WHOLE])
                    out.trust[b + bit:b + 2 * len(p):2] = _trust(n0 + n1)
        return out


@dataclass
class Learned:
    """What one piece of the words gives: weights, how many bits each gate saw, and the places and hits of the refinement."""

    weights: np.ndarray
    met: np.ndarray
    seen: np.ndarray
    hits: np.ndarray


def learn_piece(inputs: Inputs, words: list[bytes], times: np.ndarray, passes: int = 1, batch: int = 256, rate: float = 0.09) -> Learned:
    """Online gradient steps on the gated weights over all ``words``, each for all its ``times``, and how the mixed probability fares on them.

    A word is predicted from counts that lack one occurrence of it. Frequent words come in several steps, each with a part of their times.
    """
    weights = np.zeros((_GATES, len(CONTEXTS) + 1), dtype=np.float32)
    weights[:, :-1] = 0.25
    out = Learned(weights, np.zeros(_GATES), np.zeros((256, _LEVELS)), np.zeros((256, _LEVELS)))
    steps = np.ceil(times / (4 * times.mean())).astype(np.int64) if len(words) else np.empty(0, dtype=np.int64)
    drawn, share = np.repeat(np.arange(len(words)), steps), np.repeat(times / np.maximum(steps, 1), steps).astype(np.float32)
    moments = np.full_like(weights, 1e-3)
    for turn in range(passes):
        order = np.random.default_rng(3 + turn).permutation(len(drawn))
        for start in range(0, len(order), 2_048):
            at = order[start:start + 2_048]
            s = Spelled.of([words[k] for k in drawn[at]], once=True)
            taken = s.slots * 2 + s.bits
            gates = inputs.trust[taken[_WHOLE] - 2 * _OFFSETS[_WHOLE]] * np.int16(_PLACES) + s.places.astype(np.int16)
            bits = (8 * s.spelled[:, None] + np.arange(8)).reshape(-1)
            group = np.repeat((s.words // batch).astype(np.int16), 8)
            by_gate = np.argsort(group * np.int16(_GATES) + gates.take(bits), kind="stable")  # groups stay in their order
            bits = bits.take(by_gate)
            xs = np.ones((len(by_gate), len(CONTEXTS) + 1), dtype=np.float32)
            for i, slots in enumerate(taken):
                xs[:, i] = inputs.stretched.take(slots).take(bits)
            ys, gs, ns, zs = s.bits.take(bits).astype(np.float32), gates.take(bits), np.repeat(share[at][s.words], 8).take(by_gate), np.empty(len(by_gate), dtype=np.float32)
            ends = np.searchsorted(group, np.arange(1, -(-len(at) // batch) + 1))
            for a, b in zip([0, *ends], ends):
                x, y, g, n = xs[a:b], ys[a:b], gs[a:b], ns[a:b]
                zs[a:b] = z = np.einsum("ij,ij->i", weights.take(g, axis=0), x)
                first = np.flatnonzero(np.diff(g, prepend=np.int16(-1)))
                met = g[first]
                step = np.add.reduceat((n * (y - sigmoid(z)))[:, None] * x, first, axis=0)
                moments[met] += step * step
                weights[met] += np.float32(rate) * step / np.sqrt(moments[met])
                out.met[met] += np.add.reduceat(n, first)
            if turn == passes - 1:
                cells = s.states.take(bits) * _LEVELS + _level(zs)
                out.seen += np.bincount(cells, weights=ns, minlength=out.seen.size).reshape(out.seen.shape)
                out.hits += np.bincount(cells, weights=ns * ys, minlength=out.seen.size).reshape(out.seen.shape)
    return out


def mixed(zeros: np.ndarray, ones: np.ndarray, pieces: list[Learned]) -> MixingModel:
    """The model of all pieces: weights are averaged, each gate by the bits it saw there; the refinement adds up."""
    weights, met = np.zeros((_GATES, len(CONTEXTS) + 1)), np.zeros(_GATES)
    weights[:, :-1] = 0.25
    seen, hits = np.full((256, _LEVELS), 8.0), np.tile(sigmoid(np.arange(_LEVELS) - _LEVELS / 2 + 0.5), (256, 1)) * 8.0
    for piece in pieces:
        met += piece.met
        weights += (piece.weights - weights) * (piece.met / np.maximum(met, 1e-9))[:, None]
        seen, hits = seen + piece.seen, hits + piece.hits
    return MixingModel.of(zeros, ones, weights, hits / seen)


def learn_mixing(zeros: np.ndarray, ones: np.ndarray, words: list[bytes], times: np.ndarray, stream: int = STREAM_WORDS) -> MixingModel:
    """The model learned from one piece, which is gone through until ``stream`` words were seen."""
    return mixed(zeros, ones, [learn_piece(Inputs.of(zeros, ones), words, times, passes_of(len(words), stream))])


def passes_of(words: int, stream: int = STREAM_WORDS) -> int:
    return min(max(1, -(-stream // max(words, 1))), 100)


# ---- states of texts ---------------------------------------------------------------------------------------------------------------


def letter_shares(words: list[bytes]) -> np.ndarray:
    counts = np.bincount(np.frombuffer(b"".join(words), dtype=np.uint8), minlength=256).astype(float)
    return np.sqrt(counts / max(counts.sum(), 1.0))


def _opening_shares(texts: DataFrame) -> DataFrame:
    """``x``: letter shares of the first words of every text, as whole numbers, and ``u``: a number above 0 and up to 1 that stands for a random one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in text_runs(batch.column("text")):
                openings = [b" ".join(t.split(None, STATE_AFTER[-1])[:STATE_AFTER[-1]]).translate(_LOWER).split() for t in texts]
                x = [np.round(letter_shares(words) * _WHOLE_SHARE).astype("<u2").tobytes() for words in openings]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), batch.column("u").slice(start, stop - start)], ["x", "u"])

    u = (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) + 1) / F.lit(float(1 << 40))
    return texts.select("text", u.alias("u")).mapInArrow(work, "x binary, u double")


def _shares(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")  # all of one width
    return np.frombuffer(column.buffers()[2], dtype="<u2", count=256 * len(column), offset=512 * column.offset).reshape(-1, 256).astype(np.float64)


def _far(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(np.einsum("ij,ij->i", x, x)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1), 0)


def _next_start(shares: DataFrame, centres: np.ndarray | None) -> np.ndarray | None:
    """One text drawn by its squared distance from the centres: the least of waiting times at these rates."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            if batch.num_rows:
                x, u = _shares(batch), batch.column("u").to_numpy()
                rate = np.ones(len(x)) if centres is None else _far(x, centres).min(axis=1)
                wait = np.where(rate > 0, -np.log(u) / np.maximum(rate, 1), np.inf)
                k = min(np.flatnonzero(wait == wait.min()), key=lambda i: x[i].tobytes())
                best = min([(float(wait[k]), x[k].astype("<u2").tobytes()), *([best] if best else [])])
        if best and (best[0] < np.inf or centres is None):
            yield pa.RecordBatch.from_arrays([pa.array([best[0]]), pa.array([best[1]], pa.binary())], ["wait", "x"])

    found = [tuple(r) for r in shares.mapInArrow(work, "wait double, x binary").collect()]  # one row per task
    return np.frombuffer(min((w, bytes(x)) for w, x in found)[1], dtype="<u2").astype(np.float64) if found else None


def find_states(texts: DataFrame) -> np.ndarray:
    """Centres of STATES - 1 clusters of the letter shares of all ``texts`` (k-means from spread-out starts; sums of whole numbers, so rows may come in any order)."""
    shares = materialize(_opening_shares(texts), "lm-openings")
    first = _next_start(shares, None)
    if first is None:
        return np.zeros((STATES - 1, 256))
    centres = first[None]
    while len(centres) < STATES - 1:
        more = _next_start(shares, centres)
        centres = np.append(centres, (centres[0] if more is None else more)[None], axis=0)

    for _ in range(STATE_ROUNDS):
        def work(batches: Iterator[pa.RecordBatch], centres: np.ndarray = centres) -> Iterator[pa.RecordBatch]:
            sums, n = np.zeros(centres.shape), np.zeros(len(centres), dtype=np.int64)
            for batch in batches:
                if batch.num_rows:
                    x = _shares(batch)
                    own = np.eye(len(centres))[_far(x, centres).argmin(axis=1)]
                    sums, n = sums + own.T @ x, n + own.sum(axis=0).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["sums", "n"])

        parts = shares.mapInArrow(work, "sums binary, n binary").collect()  # one row per task, as large as the centres
        sums, n = sum(np.frombuffer(r["sums"]).reshape(centres.shape) for r in parts), sum(np.frombuffer(r["n"], dtype=np.int64) for r in parts)
        moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        if np.abs(moved - centres).max() < _WHOLE_SHARE * 1e-4:
            break
        centres = moved
    return centres / _WHOLE_SHARE


def state_spans(words: list[bytes], centres: np.ndarray) -> list[tuple[int, int | None, int]]:
    """(first, stop, state) of the words' runs of one state; the last state is that at the end."""
    out, state, begin = [], 0, 0
    for stop in (*STATE_AFTER, None):
        out.append((begin, stop, state))
        if stop is None or len(words) < stop:
            return out
        shares, begin = letter_shares(words[:stop]), stop
        state = 1 + int(((centres - shares) ** 2).sum(axis=1).argmin())


# ---- word triples --------------------------------------------------------------------------------------------------------------------

_OF_PIECE = {"piece": "int", "codes": "binary", "shares": "binary", "rests": "binary"}
_END, _START, _BEFORE = np.uint64(1), np.uint64(2), np.uint64(3)  # in place of words' hashes


def word_hashes(words: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array([*words, b""], dtype=object)[:-1], categorize=False) >> np.uint64(64 - WORD_BITS)


def triple_keys(hashes: np.ndarray, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A key per token of all ``docs`` (lists of places in ``hashes``, the end follows): the hash of the two tokens before it, then its own; and where every text begins."""
    lengths = np.fromiter(map(len, docs), dtype=np.int64, count=len(docs)) + 1
    first = np.cumsum(lengths) - lengths
    own = np.append(hashes, _END)[np.concatenate([x for d in docs for x in (d, [len(hashes)])])]
    one, two = np.roll(own, 1), np.roll(own, 2)
    one[first], two[first] = _START, _BEFORE
    two[first[lengths > 1] + 1] = _START
    with np.errstate(over="ignore"):
        pair = mix64(two * np.uint64(0x9E3779B97F4A7C15) + mix64(one + np.uint64(0x632BE59BD9B4E019)))
        return pair >> np.uint64(64 - PAIR_BITS) << np.uint64(NEXT_BITS) | mix64(own + pair) >> np.uint64(64 - NEXT_BITS), first


def squeeze_keys(keys: np.ndarray) -> bytes:
    """Rising keys, as the bytes of their differences."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def expand_keys(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=np.uint64)


def discounted(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``keys`` with their training counts, several from different runs: a code each, and per code the probability of the triple's last word and the weight of its spelling.

    The discount is the share of counts that one occurrence more or less makes (once over once and twice twice), so what a text itself added counts for little.
    """
    distinct, own = np.unique(keys, return_inverse=True)
    c = np.bincount(own, weights=times, minlength=len(distinct)).astype(np.int64)
    begins = np.flatnonzero(np.diff(distinct >> np.uint64(NEXT_BITS), prepend=~np.uint64(0)))
    per_pair = np.diff(np.append(begins, len(distinct)))
    n, followers = (np.repeat(np.add.reduceat(x, begins), per_pair) for x in (c, (c > 0).astype(np.int64)))
    once, twice = int((c == 1).sum()), int((c == 2).sum())
    discount = (once + 1) / (once + 2 * twice + 1)
    order = np.lexsort((followers, n, c))
    new = np.zeros(len(order), dtype=bool)
    for x in (c, n, followers):
        new[1:] |= np.diff(x[order]) != 0
    code = np.empty(len(order), dtype=np.int64)
    code[order] = np.cumsum(new)
    kinds = order[np.flatnonzero(np.append(True, new[1:]))] if len(order) else order
    c, n, followers = (x[kinds].astype(float) for x in (c, n, followers))
    share = np.where(n > 0, np.maximum(c - discount, 0) / np.maximum(n, 1), 0.0)
    rest = np.where(n > 0, np.minimum(discount, 1.0) * followers / np.maximum(n, 1), 1.0)
    return code[own], share, rest


# ---- packed numbers ------------------------------------------------------------------------------------------------------------------


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32, byte by byte of all of them, compressed."""
    return zlib.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def pack_hashes(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BITS // 8]).tobytes()


def unpack_hashes(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) * 8 // WORD_BITS, 8), dtype=np.uint8)
    out[:, :WORD_BITS // 8] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, WORD_BITS // 8)
    return out.view("<u8").reshape(-1)


def expand(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


# ---- Spark -------------------------------------------------------------------------------------------------------------------------


def _runs(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """Documents in runs: per document its words with states (as places in the run's list); per run its words and their training counts, and their hashes."""

    def flush(run, words, docs, sequences):
        names = [b""] * sum(map(len, words))
        for state, known in enumerate(words):
            mark = bytes([state])
            for word, place in known.items():
                names[place] = mark + word
        hashes = word_hashes([w[1:] for w in names])
        counts = np.bincount(np.concatenate([[], *[x for x, d in zip(sequences, docs) if not d[2]]]).astype(np.int64), minlength=len(names))
        out = [(*d, squeeze(x), *[None] * 4) for d, x in zip(docs, sequences)]
        for start in range(0, len(names), WORDS_PER_ROW):
            out.append((run, *[None] * 6, start, names[start:start + WORDS_PER_ROW], counts[start:start + WORDS_PER_ROW].tolist(), None))
        out.append((run, *[None] * 9, pack_hashes(hashes)))
        columns = list(zip(*out))
        types = [pa.int64(), id_type[0], pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()]
        step = 2_000
        for a in range(0, len(out), step):
            yield pa.RecordBatch.from_arrays([pa.array(col[a:a + step], t) for col, t in zip(columns, types)],
                                             ["run", "doc_id", "held_out", "n_tokens", "n_bytes", "end_state", "places", "first", "words", "counts", "hashes"])

    id_type: list = [None]

    def empty() -> tuple[list[defaultdict[bytes, int]], list, list, int]:
        places = count()  # words are numbered as they come, in all states
        return [defaultdict(places.__next__) for _ in range(STATES)], [], [], 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 24
        words, docs, sequences, size = empty()
        for batch in batches:
            id_type[0] = batch.schema.field("doc_id").type
            ids, folds = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for start, stop, texts in text_runs(batch.column("text")):
                for doc, held, text in zip(ids[start:stop], folds[start:stop], texts):
                    split = text.translate(_LOWER).split()
                    spans = state_spans(split, centres)
                    sequences.append(np.fromiter(chain.from_iterable(map(words[g].__getitem__, split[a:b]) for a, b, g in spans), dtype=np.int32, count=len(split)))
                    docs.append((run, doc, held, len(split) + 1, sum(map(len, split)) + len(split) + 1, spans[-1][-1]))
                    size += len(text)
                    if size >= RUN_BYTES or sum(map(len, words)) >= RUN_WORDS:
                        yield from flush(run, words, docs, sequences)
                        run += 1
                        words, docs, sequences, size = empty()
        if docs:
            yield from flush(run, words, docs, sequences)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"run long, doc_id {kind}, held_out boolean, n_tokens long, n_bytes long, end_state int, places binary, "
                           "first int, words array<binary>, counts array<long>, hashes binary")


def _of_run(rows: pa.Table) -> tuple[np.ndarray, pa.Table, list[np.ndarray]]:
    """Hashes of a run's words, its documents, and the words of each as places among them."""
    known = pc.is_valid(rows.column("hashes"))
    docs = rows.filter(pc.invert(known))
    return unpack_hashes(rows.filter(known).column("hashes")[0].as_py()), docs, [expand(x).astype(np.int64) for x in docs.column("places").to_pylist()]


def _answers_of_pieces(sides: DataFrame, tokens: int) -> DataFrame:
    """``run, piece, codes, shares, rests``: what all training texts say of a run's distinct triples in one piece, in their order."""
    together = max(1, min(PIECES, PIECES * TRIPLES_PER_GROUP // max(tokens, 1)))

    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        hashes, docs, places = _of_run(rows)
        keys, first = triple_keys(hashes, places)
        learned = np.repeat(~docs.column("held_out").to_numpy(), np.diff(np.append(first, len(keys))))
        distinct, own = np.unique(keys, return_inverse=True)
        times = np.bincount(own, weights=learned, minlength=len(distinct))
        cuts = np.searchsorted(distinct, np.arange(PIECES + 1, dtype=np.uint64) << np.uint64(PAIR_BITS + NEXT_BITS - 10))
        pieces = np.flatnonzero(np.diff(cuts))
        columns = [[pack(x[cuts[p]:cuts[p + 1]]) for p in pieces] for pack, x in ((squeeze_keys, distinct), (squeeze, times))]
        return pa.table([pa.array([key[0].as_py()] * len(pieces), pa.int64()), pa.array(pieces, pa.int32()), *[pa.array(x, pa.binary()) for x in columns]], names=["run", "piece", "keys", "times"])

    def count_group(key: tuple, rows: pa.Table) -> pa.Table:
        keys = [expand_keys(x) for x in rows.column("keys").to_pylist()]
        codes, shares, rests = discounted(np.concatenate(keys), np.concatenate([expand(x) for x in rows.column("times").to_pylist()]))
        parts = [np.unique(x, return_inverse=True) for x in np.split(codes, np.cumsum([len(k) for k in keys])[:-1])]
        columns = [[squeeze(own) for _, own in parts], *[[of[kinds].tobytes() for kinds, _ in parts] for of in (shares, rests)]]
        return pa.table([rows.column("run"), rows.column("piece"), *[pa.array(x, pa.binary()) for x in columns]], names=["run", "piece", "codes", "shares", "rests"])

    asked = sides.groupBy("text_run").applyInArrow(ask, "run long, piece int, keys binary, times binary")
    return asked.withColumn("group", F.floor(F.col("piece") / F.lit(together)).cast("int")).groupBy("group").applyInArrow(count_group, "run long, piece int, codes binary, shares binary, rests binary")


def _count_tables(vocabulary: DataFrame, ends: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Bit counts of all contexts over all training words. The tables have a fixed size, whatever the words."""
    size, pieces = int(_OFFSETS[-1]), 64
    width = -(-size // pieces)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zeros, ones = np.zeros(size, dtype=np.float32), np.zeros(size, dtype=np.float32)
        any_row = False
        for batch in batches:
            any_row = any_row or batch.num_rows > 0
            bit_counts([w + b" " for w in batch.column("word").to_pylist()], batch.column("c").to_numpy(), zeros, ones)
        for k in range(pieces if any_row else 0):
            both = [squeeze(np.minimum(t[k * width:(k + 1) * width], MOST)) for t in (zeros, ones)]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([both[0]], pa.binary()), pa.array([both[1]], pa.binary())], ["piece", "zeros", "ones"])

    def total(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sums = [squeeze(np.minimum(sum(expand(x).astype(np.float64) for x in frame[name]), MOST)) for name in ("zeros", "ones")]
        return pd.DataFrame({"piece": [key[0]], "zeros": [sums[0]], "ones": [sums[1]]})

    schema = "piece int, zeros binary, ones binary"
    parts = parts_for(vocabulary.count(), 1_000_000)
    summed = vocabulary.where("c > 0").coalesce(parts).mapInArrow(add, schema).groupBy("piece").applyInPandas(total, schema).toArrow().sort_by("piece")
    out = []
    for name in ("zeros", "ones"):
        pieces_found = summed.column(name).to_pylist()
        out.append(np.concatenate([expand(x) for x in pieces_found]).astype(np.float32) if pieces_found else np.zeros(size, dtype=np.float32))
    if ends:
        bit_counts([bytes([g]) + b"\n" for g in ends], np.array(list(ends.values())), *out)
    return out[0], out[1]


def _learn(vocabulary: DataFrame, zeros: np.ndarray, ones: np.ndarray, known_pairs: int) -> list[Learned]:
    """What every piece of the training words teaches. Pieces follow the words' hashes, so they are the same however rows are dealt."""
    inputs = vocabulary.sparkSession.sparkContext.broadcast(Sent(Inputs.of, zeros, ones))  # tables of fixed size
    pieces, passes = parts_for(known_pairs, PIECE_WORDS), passes_of(known_pairs)

    def learn(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("word")
        found = learn_piece(inputs.value.built, [w + b" " for w in rows.column("word").to_pylist()], rows.column("c").to_numpy().astype(float), passes)
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int64()), "found": pa.array([zlib.compress(b"".join(x.astype("<f8").tobytes() for x in (found.weights, found.met, found.seen, found.hits)), 1)], pa.binary())})

    words = vocabulary.where("c > 0").select("word", "c", F.pmod(F.xxhash64("word"), F.lit(pieces)).alias("piece"))
    found = words.repartition(pieces, "piece").groupBy("piece").applyInArrow(learn, "piece long, found binary").toArrow().sort_by("piece")  # some 100 kB a piece
    inputs.destroy()
    cuts, width = np.cumsum([_GATES * (len(CONTEXTS) + 1), _GATES, 256 * _LEVELS]), len(CONTEXTS) + 1
    parts = [np.split(np.frombuffer(zlib.decompress(x)), cuts) for x in found.column("found").to_pylist()]
    return [Learned(w.reshape(-1, width), met, seen.reshape(256, -1), hits.reshape(256, -1)) for w, met, seen, hits in parts]


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    rows = narrow(docs, id_col, text_col)
    tagged = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    runs = materialize(_runs(tagged, find_states(tagged.where("NOT held_out").select("doc_id", "text"))), "lm-runs")
    texts = runs.where("n_tokens IS NOT NULL")
    asked = runs.where("words IS NOT NULL").select("run", "first", F.posexplode(F.arrays_zip("words", "counts")).alias("i", "x")).select(
        "run", (F.col("first") + F.col("i")).alias("place"), F.col("x.words").alias("word"), F.col("x.counts").alias("c"))
    # one exchange by spelling serves the counts per word and state and the totals per word
    spelled = asked.select("word", "c").repartition(F.expr("substring(word, 2)")).select(F.expr("substring(word, 2)").alias("spelling"), "word", "c")
    pairs = spelled.groupBy("spelling", "word").agg(F.sum("c").alias("c"))
    alike = Window.partitionBy("spelling")  # STATES rows at most
    once = F.row_number().over(alike.orderBy("word")) == 1
    vocabulary = materialize(pairs.select("word", "c", F.sum("c").over(alike).alias("total"), once.alias("once")), "lm-vocabulary")
    end_counts = {r[0]: r[1] for r in texts.where("NOT held_out").groupBy("end_state").count().collect()}  # one row per state
    ends = sum(end_counts.values())
    known_words, known_pairs, word_tokens = vocabulary.agg(F.count_if(F.col("once") & (F.col("total") > 0)), F.count_if(F.col("c") > 0), F.coalesce(F.sum("c"), F.lit(0))).first()
    total, distinct = word_tokens + ends, known_words + (ends > 0)
    zeros, ones = _count_tables(vocabulary, end_counts)
    model = mixed(zeros, ones, _learn(vocabulary, zeros, ones, known_pairs))
    shared = spark.sparkContext.broadcast(Sent(MixingModel.of, zeros, ones, model.weights, model.refined))  # tables of fixed size

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lp = shared.value.built.log10([w + b" " for w in batch.column("word").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("total"), pa.array(lp, pa.float64())], ["word", "c", "lp"])

    scored = vocabulary.select("word", "total").mapInArrow(spell, "word binary, c long, lp double")
    nothing = F.lit(None)
    answers = asked.drop("c").join(scored, "word").select("run", "place", "c", F.col("lp").cast("float").alias("lp"), *[nothing.cast(kind).alias(n) for n, kind in _OF_PIECE.items()])
    tokens = runs.agg(F.sum("n_tokens")).first()[0] or 0
    sides = runs.where("n_tokens IS NOT NULL OR hashes IS NOT NULL").select(F.col("run").alias("text_run"), "doc_id", "held_out", "n_tokens", "n_bytes", "end_state", "places", "hashes")
    of_pieces = _answers_of_pieces(sides, tokens).select("run", *[nothing.cast(kind).alias(n) for n, kind in (("place", "int"), ("c", "long"), ("lp", "float"))], *_OF_PIECE)
    norm, end_lp, end_known = total + 0.5 * (distinct + 1), model.log10([bytes([g]) + b"\n" for g in range(STATES)]), int(ends > 0)
    end_base = float(np.log10((ends + 0.5) / norm))

    def finish(key, left: pa.Table, right: pa.Table) -> pa.Table:
        spelled, pieces = right.filter(pc.is_null(right.column("piece"))), right.filter(pc.is_valid(right.column("piece"))).sort_by("piece")
        place, c, lp = (spelled.column(n).to_numpy() for n in ("place", "c", "lp"))
        size = int(place.max()) + 1 if len(place) else 0
        base, model_lp, known = np.zeros(size), np.zeros(size), np.zeros(size, dtype=np.int64)
        base[place], model_lp[place], known[place] = np.log10((c + 0.5) / norm), lp, c > 0
        hashes, left, docs = _of_run(left)
        states = left.column("end_state").to_numpy()
        keys, first = triple_keys(hashes, docs)
        own = np.unique(keys, return_inverse=True)[1]
        share, rest = (np.concatenate([np.frombuffer(of)[expand(codes)] for of, codes in zip(pieces.column(n).to_pylist(), pieces.column("codes").to_pylist())])[own] for n in ("shares", "rests"))
        ends = np.append(first[1:], len(keys)) - 1
        low = np.zeros(len(keys))
        words = np.ones(len(keys), dtype=bool)
        words[ends], low[ends] = False, end_lp[states]
        sequence = np.concatenate([np.empty(0, dtype=np.int64), *docs])
        low[words] = model_lp[sequence]
        with np.errstate(divide="ignore"):
            each = np.where(share > 0, np.log10(share + rest * 10.0**low), np.log10(rest) + low)
        sums = [np.zeros(len(keys)), np.zeros(len(keys), dtype=np.int64)]
        for total_of, of_word, of_end in zip(sums, (base, known), (end_base, end_known)):
            total_of[words], total_of[ends] = of_word[sequence], of_end
        base_col, known_col, model_col = (np.add.reduceat(x, first) for x in (*sums, each))
        return pa.table([left.column("doc_id"), left.column("held_out"), left.column("n_tokens"), pa.array(known_col, pa.int64()), pa.array([total] * len(docs), pa.int64()),
                         pa.array(base_col, pa.float64()), pa.array(model_col, pa.float64()), left.column("n_bytes")],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    done = sides.groupBy("text_run").cogroup(answers.unionByName(of_pieces).groupBy("run")).applyInArrow(
        finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long")
    return done.withColumn("bits_per_byte", -F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).drop("n_bytes")
