"""Token counts by finite-state transducers.

Two machines run over a batch of texts as one stream of characters.

The first cuts the stream into pre-tokens (contractions, words, numbers, signs, white space). Its
transitions are compiled from the rule of byte-level BPE into a table of twelve states by twelve
character classes, each transition annotated with the places at which a pre-token begins. The stream
is cut into chunks of equal length; every chunk is run from all states at once, which gives a map from
the state before it to the state after it; the maps compose in a parallel prefix scan to each
chunk's true first state; a second run from there yields the places.

The second reads a pre-token: its state after some characters is an affine hash of them, h * P + c,
so the maps of any stretch compose as well, and one running sum over the stream gives all of them.
The transition out of a pre-token is annotated with the number of tokens it emits, which is compiled
with the vocabulary's own merges when a state first ends a pre-token, and remembered up to a bound.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cohortloom.llm.text import decoded

# Character classes. The letters of the contractions 's 't 'm 'd, 're, 've, 'll stand apart.
LETTER, SHORT, R, V, EL, E, NUMBER, BLANK, WHITE, QUOTE, SIGN, END = range(12)
UNKNOWN = 255
# States: fresh (a pre-token begins with the next character), in letters, in numbers, in signs; one
# white-space character, blank or other; more of them, the last a blank or other; after a quote that
# begins a pre-token; after that quote and r, v, l.
FRESH, IN_L, IN_N, IN_S, ONE_B, ONE_W, MORE_B, MORE_W, AFTER_Q, Q_R, Q_V, Q_L = range(12)
HERE, BEFORE = 1, 2  # a pre-token begins at this character; at the one before
#: The code points of Unicode's White_Space property.
SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_LETTERS = {LETTER, SHORT, R, V, EL, E}
#: Characters of a chunk, and twice the bytes of text handled at once inside a task.
CHUNK = 128
BATCH = 1_000_000
#: Pre-tokens remembered per worker.
REMEMBERED = 3_000_000
_P = np.uint64(0x5851F42D4C957F2D)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_MACHINES: dict[str, Machine] = {}


def _begin(cls: int, spaced: bool) -> int:
    """State after the first character of a run, which a blank before it may have joined."""
    if cls in _LETTERS:
        return IN_L
    if cls == NUMBER:
        return IN_N
    return AFTER_Q if cls == QUOTE and not spaced else IN_S


def transition(state: int, cls: int) -> tuple[int, int]:
    """(next state, places at which pre-tokens begin) on one character."""
    if state in (Q_R, Q_V, Q_L):
        if cls == (EL if state == Q_L else E):
            return FRESH, 0
        after, places = transition(IN_L, cls)  # no contraction: the letter began a word
        return after, places | BEFORE
    if cls == END:
        return FRESH, 0
    if state == AFTER_Q:
        if cls == SHORT:
            return FRESH, 0
        if cls in (R, V, EL):
            return {R: Q_R, V: Q_V, EL: Q_L}[cls], 0
        if cls in (QUOTE, SIGN):
            return IN_S, 0
        state = IN_S
    white = cls in (BLANK, WHITE)
    if state in (ONE_B, ONE_W, MORE_B, MORE_W):
        if white:
            return (MORE_B if cls == BLANK else MORE_W), 0
        last = BEFORE if state in (MORE_B, MORE_W) else 0
        joined = state in (ONE_B, MORE_B)
        return _begin(cls, joined), last | (0 if joined else HERE)
    if white:
        return (ONE_B if cls == BLANK else ONE_W), HERE
    same = {IN_L: cls in _LETTERS, IN_N: cls == NUMBER, IN_S: cls in (QUOTE, SIGN)}.get(state, False)
    return (state, 0) if same else (_begin(cls, False), HERE)


_STEPS = [transition(s, c) for c in range(12) for s in range(12)]
#: Both indexed by class * 12 + state.
NEXT = np.array([s for s, _ in _STEPS], np.uint8)
PLACES = np.array([p for _, p in _STEPS], np.uint8)


def compose_prefixes(maps: np.ndarray) -> np.ndarray:
    """For maps (chunks, states), row i: the map of chunks 0 to i one after the other; a doubling scan."""
    out, step = maps.copy(), 1
    while step < len(out):
        later = np.take_along_axis(out[step:], out[:-step].astype(np.intp), axis=1)
        out[step:] = later
        step *= 2
    return out


def begins(classes: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each character of a stream that ends with END."""
    n = -(-len(classes) // CHUNK)
    padded = np.full(n * CHUNK, END, np.uint8)
    padded[: len(classes)] = classes
    columns = np.ascontiguousarray(padded.reshape(n, CHUNK).T)
    maps = np.tile(np.arange(12, dtype=np.uint8), (n, 1))
    at = 0
    while at < CHUNK and not (maps == maps[:, :1]).all():
        maps = NEXT[columns[at][:, None] * np.uint8(12) + maps]
        at += 1
    if at < CHUNK:  # every chunk has come to one state whatever came before: one run goes on for all twelve
        state = maps[:, 0].copy()
        for j in range(at, CHUNK):
            state = NEXT[columns[j] * np.uint8(12) + state]
        maps = np.repeat(state[:, None], 12, axis=1)
    scanned = compose_prefixes(maps)
    state = np.concatenate(([FRESH], scanned[:-1, FRESH])).astype(np.uint8)
    places = np.empty((CHUNK, n), np.uint8)
    for j in range(CHUNK):
        step = columns[j] * np.uint8(12) + state
        places[j] = PLACES[step]
        state = NEXT[step]
    flat = places.T.reshape(-1)[: len(classes)]
    out = (flat & HERE).astype(bool)
    out[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return out


class Machine:
    """Both transducers for one vocabulary file of the tokenizers library, byte-level BPE with the usual rule."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.classes[SPACES] = WHITE
        for chars, cls in (("stmd", SHORT), ("r", R), ("v", V), ("l", EL), ("e", E), (" ", BLANK), ("'", QUOTE)):
            self.classes[[ord(c) for c in chars]] = cls
        self.remembered = remembered
        self.states, self.emits = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        steps = np.full(BATCH, _P)
        steps[0] = 1
        self.powers = np.cumprod(steps)
        steps[1:] = _P_INVERSE
        self.inverse = np.cumprod(steps)

    def classify(self, chars: np.ndarray) -> np.ndarray:
        """Classes of code points; unseen ones are asked of the vocabulary's own pre-tokenizer."""
        out = self.classes[chars]
        if (out == UNKNOWN).any():
            new = np.unique(chars[out == UNKNOWN])
            probe = "".join(f"a{chr(c)}1" for c in new)
            starts = {span[0] for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)}
            self.classes[new] = [
                LETTER if 3 * i + 1 not in starts else NUMBER if 3 * i + 2 not in starts else SIGN for i in range(len(new))
            ]
            out = self.classes[chars]
        return out

    def emitted(self, stream: str, begin: np.ndarray, end: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token [begin, end) of the stream."""
        grown = self.powers, self.inverse
        if len(chars) + 1 > len(self.powers):  # one very long text
            steps = np.full(len(chars) + 1, _P)
            steps[0] = 1
            grown = (np.cumprod(steps), np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(chars), _P_INVERSE)))))
        sums = np.concatenate(([np.uint64(0)], np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * grown[1][: len(chars)])))
        states = (sums[end] - sums[begin]) * grown[0][end - 1] + (end - begin).astype(np.uint64)
        states ^= states >> np.uint64(31)
        distinct, first, back = np.unique(states, return_index=True, return_inverse=True)
        if len(self.states) > self.remembered:
            self.states, self.emits = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        at = np.searchsorted(self.states, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.states)
        known[inside] = self.states[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        for a in range(0, len(new), 1000):
            part = new[a : a + 1000]
            coded = self.batch([stream[begin[i] : end[i]] for i in first[part]], add_special_tokens=False)
            spots = np.searchsorted(self.states, distinct[part])
            self.states = np.insert(self.states, spots, distinct[part])
            self.emits = np.insert(self.emits, spots, [len(c.ids) for c in coded])
        return self.emits[np.searchsorted(self.states, distinct)][back]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a special string inside a text is one token and cuts the text, as is the library's default."""
        out = np.zeros(len(texts), np.int64)
        owner, parts = [], []
        for i, text in enumerate(texts):
            mine = [text]
            for s in self.special:
                if any(s in x for x in mine):
                    cut = [x.split(s) for x in mine]
                    out[i] += sum(len(x) - 1 for x in cut)
                    mine = [y for x in cut for y in x]
            owner += [i] * len(mine)
            parts += mine
        stream = "\0".join(parts) + "\0"
        chars = np.frombuffer(stream.encode("utf-32-le", "replace"), "<u4")
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        classes = self.classify(chars).copy()
        classes[ends] = END
        starts = begins(classes)
        bound = starts.copy()
        bound[ends] = True
        spots = np.flatnonzero(bound)
        is_start = starts[spots]
        begin, end = spots[is_start], spots[1:][is_start[:-1]]
        if len(begin):
            tokens = self.emitted(stream, begin, end, chars)
            texts_of = np.array(owner)[np.searchsorted(ends, begin)]
            out += np.bincount(texts_of, weights=tokens, minlength=len(texts)).astype(np.int64)
        return out


def machine(path: str) -> Machine:
    """One per worker and file."""
    if path not in _MACHINES:
        _MACHINES[path] = Machine(path)
    return _MACHINES[path]


def token_count(text: Column, vocabulary: str) -> Column:
    """Number of tokens of a text under a vocabulary file that the executors can read; null and empty texts have none."""

    @F.arrow_udf(LongType())
    def counted(column: pa.Array) -> pa.Array:
        run = machine(vocabulary)
        out = [run.count(texts) for texts in decoded(column, BATCH // 2)]
        return pa.array(np.concatenate(out or [np.zeros(0, np.int64)]))

    return counted(text)
