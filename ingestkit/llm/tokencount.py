r"""Token counts of a byte-level BPE, by compiled finite-state transducers.

Two deterministic transducers are compiled from the tokenizer's file:

* The splitter reads character classes and emits, delayed by at most two
  characters, where pieces begin (the rule of the ``ByteLevel`` splitter:
  contractions, an optional blank before runs of letters, of numbers and of
  other characters, runs of white space whose last one is left over).  A batch is cut into
  chunks; each chunk's state map (start state -> end state) is computed for
  all chunks at once, a parallel prefix scan composes the maps into each
  chunk's true start state, and a second pass emits the boundaries.
* The encoder reads the bytes of a piece.  Its states are the determinised
  sets of (last token, place in the token trie, residual count): a token may
  end where BPE, given the last token, would end it; which two tokens may
  stand next to each other is decided by running the merges on the two alone.
  Every transition carries the number of tokens emitted for certain, every
  state the number due at the end.  States are made when first reached and
  kept in a table of bounded size; all different pieces of a batch walk
  through it together, one byte a step.

Special tokens inside a text count as the library's default has it: one token,
and the text on either side is split on its own.

Cases: null and empty texts have no bytes and no tokens; texts of any length
are read whole; repeated rows are counted each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm import textscan

# Character classes; END separates texts.
LETTER, STMD, RV, EL, EE, NUMBER, BLANK, SPACE, OTHER, QUOTE, END = range(11)
# Splitter states: what the piece being read is.
(START, IN_L, IN_N, IN_O, ONE_BLANK, ONE_SPACE, BLANKS, SPACES, Q, Q_RV, Q_L, DONE) = range(12)
N_STATES = 12
# The encoder: its first state; pieces longer than LONG bytes are cut into chunks, whose
# states are guessed from the WARM bytes before them.
FIRST = ((b"", 0, 0),)
LONG, CHUNK, WARM = 4096, 512, 64
NOW, BACK1 = 1, 2        # a piece begins at this character; at the one before


def _classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    # white space as the Unicode property has it (not the information separators)
    for c in [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]:
        out[c] = SPACE
    out[0x20] = BLANK
    for chars, k in (("stmd", STMD), ("rv", RV), ("l", EL), ("e", EE), ("'", QUOTE)):
        for ch in chars:
            out[ord(ch)] = k
    return out


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, emitted marks) by state and class."""
    letters = (LETTER, STMD, RV, EL, EE)
    fresh = {NUMBER: IN_N, BLANK: ONE_BLANK, SPACE: ONE_SPACE, OTHER: IN_O, QUOTE: Q} | dict.fromkeys(letters, IN_L)
    attached = {NUMBER: IN_N, OTHER: IN_O, QUOTE: IN_O} | dict.fromkeys(letters, IN_L)
    move = np.zeros((N_STATES, 11), np.uint8)
    mark = np.zeros((N_STATES, 11), np.uint8)
    for s in range(N_STATES):
        for c in range(10):
            to, marks = fresh[c], NOW
            if s == IN_L and c in letters or s == IN_N and c == NUMBER:
                marks = 0
            elif s in (IN_O, Q) and c in (OTHER, QUOTE):
                to, marks = IN_O, 0
            elif s == Q and c == STMD:
                to, marks = DONE, 0
            elif s == Q and c in (RV, EL):
                to, marks = Q_RV if c == RV else Q_L, 0
            elif (s, c) in ((Q_RV, EE), (Q_L, EL)):
                to, marks = DONE, 0
            elif s in (Q_RV, Q_L):               # no contraction: the letter began a piece
                marks = BACK1 if c in letters else BACK1 | NOW
            elif s in (ONE_BLANK, ONE_SPACE, BLANKS, SPACES):
                if c in (BLANK, SPACE):
                    to, marks = BLANKS if c == BLANK else SPACES, 0
                elif s in (ONE_BLANK, BLANKS):   # the last blank goes with what follows
                    to, marks = attached[c], BACK1 if s == BLANKS else 0
                else:
                    marks = NOW | (BACK1 if s == SPACES else 0)
            move[s, c], mark[s, c] = to, marks
        move[s, END], mark[s, END] = START, BACK1 if s in (Q_RV, Q_L) else 0
    return move, mark


def scan_states(move: np.ndarray, symbols: np.ndarray, width: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(symbols by chunk, state before each chunk) of one long input that
    begins in START: state maps of all chunks, composed by a prefix scan."""
    n = -(-len(symbols) // width)
    rows = np.full(n * width, END, np.uint8)
    rows[:len(symbols)] = symbols
    rows = np.ascontiguousarray(rows.reshape(n, width).T)
    flat = move.ravel()
    state = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (n, N_STATES)).copy()
    lane_of, lanes, where = None, state, np.arange(n)
    for i in range(width):
        if lane_of is None:
            lanes = flat[lanes.astype(np.int64) * 11 + rows[i][:, None]]
            if i % 16 == 15 or i == width - 1:   # few different states are left: one lane for each
                name = np.arange(n)[:, None] * N_STATES + lanes
                kept, lane_of = np.unique(name, return_inverse=True)
                lane_of = lane_of.reshape(n, N_STATES)
                where, lanes = kept // N_STATES, (kept % N_STATES).astype(np.uint8)
        else:
            lanes = flat[lanes.astype(np.int64) * 11 + rows[i][where]]
    maps = lanes[lane_of]
    step = 1                                     # maps[i] becomes the map of chunks 0..i
    while step < n:
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy().astype(np.int64), axis=1)
        step *= 2
    return rows, np.r_[np.uint8(START), maps[:-1, START]]


def piece_starts(symbols: np.ndarray, move: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each symbol."""
    rows, state = scan_states(move, symbols)
    marks = np.empty(rows.shape, np.uint8)
    to, out = move.ravel(), mark.ravel()
    for i in range(len(rows)):
        at = state.astype(np.int64) * 11 + rows[i]
        marks[i] = out[at]
        state = to[at]
    marks = marks.T.ravel()[:len(symbols)]
    starts = (marks & NOW) > 0
    starts[:-1] |= (marks[1:] & BACK1) > 0
    return starts


class Encoder:
    """The lazily determinised transducer of the merges; counts tokens."""

    def __init__(self, model: dict, max_states: int = 200_000, max_known: int = 1_500_000):
        self.rank, self.max_states, self.max_known = {}, max_states, max_known
        symbol = _byte_symbols()
        byte = {s: b for b, s in symbol.items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        raw = lambda s: bytes(byte[ch] for ch in s)
        for i, (a, b) in enumerate(merges):
            self.rank.setdefault((raw(a), raw(b)), i)
        tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in self.rank}
        self.tokens = {t for t in tokens if len(t) == 1 or self.encode(t) == [t]}
        self.trie: list[dict[int, int]] = [{}]
        self.ends: list[bytes | None] = [None]
        for t in sorted(self.tokens):
            node = 0
            for b in t:
                nxt = self.trie[node].get(b)
                if nxt is None:
                    nxt = self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(None)
                node = nxt
            self.ends[node] = t
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.known = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self._reset()

    def encode(self, text: bytes) -> list[bytes]:
        """Plain BPE of a short string: the first-ranked merge, leftmost first."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _reset(self) -> None:
        self.states, self.names = [FIRST], {FIRST: 0}
        self.columns = np.full(256, -1, np.int64)     # byte -> column, given when first read
        self.used = 0
        self.next = np.full((1024, 32), -1, np.int32)
        self.emit = np.zeros((1024, 32), np.int16)
        self.final = np.zeros(1024, np.int16)

    def _follows(self, last: bytes, token: bytes) -> bool:
        if not last:
            return True
        key = (last, token)
        if (fit := self.fits.get(key)) is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            fit = self.fits[key] = self.encode(last + token) == [last, token]
        return fit

    def _make(self, state: int, byte: int, column: int) -> None:
        going, ended = [], None
        for last, node, due in self.states[state]:
            child = self.trie[node].get(byte)
            if child is None:
                continue
            if self.trie[child]:
                going.append((last, child, due))
            token = self.ends[child]
            if ended is None and token is not None and self._follows(last, token):
                ended = (token, 0, due + 1)
        going.append(ended)
        least = min(x[2] for x in going)
        made = tuple((a, n, d - least) for a, n, d in going)
        self.next[state, column], self.emit[state, column] = self._named(made), least

    def _named(self, made: tuple) -> int:
        """The number of a state; its last element says what is due at the end."""
        to = self.names.get(made)
        if to is None:
            to = self.names[made] = len(self.states)
            self.states.append(made)
            if to >= len(self.next):
                more = len(self.next)
                self.next = np.vstack([self.next, np.full((more, self.next.shape[1]), -1, np.int32)])
                self.emit = np.vstack([self.emit, np.zeros((more, self.emit.shape[1]), np.int16)])
                self.final = np.r_[self.final, np.zeros(more, np.int16)]
            self.final[to] = made[-1][2]
        return to

    def _column(self, byte: int) -> int:
        if self.columns[byte] < 0:
            if self.used == self.next.shape[1]:
                self.next = np.hstack([self.next, np.full((len(self.next), 32), -1, np.int32)])
                self.emit = np.hstack([self.emit, np.zeros((len(self.emit), 32), np.int16)])
            self.columns[byte] = self.used
            self.used += 1
        return int(self.columns[byte])

    def _walked(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, begin: list[tuple]) -> tuple[list[tuple], np.ndarray]:
        """The states in which ``data[start:start + size]`` end, each from its own
        state, and the tokens emitted on the way."""
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        for b in np.flatnonzero(np.bincount(data, minlength=256)):
            self._column(int(b))
        state = np.array([self._named(begin[i]) for i in order], np.int64)
        count, live, i = np.zeros(len(start), np.int64), len(start), 0
        out: list[tuple] = [()] * len(start)
        while live:
            longer = int(np.searchsorted(-size[:live], -i, "left"))      # the first ``longer`` are longer than i
            for k in range(longer, live):
                out[order[k]] = self.states[state[k]]
            live = longer
            if not live:
                break
            if len(self.states) > self.max_states:                 # made anew from the states in use
                used, place = np.unique(state[:live], return_inverse=True)
                held = [self.states[x] for x in used]
                self._reset()
                for b in np.flatnonzero(np.bincount(data, minlength=256)):
                    self._column(int(b))
                state[:live] = np.array([self._named(x) for x in held])[place]
            column = self.columns[data[start[:live] + i]]
            to = self.next[state[:live], column]
            if (missing := np.flatnonzero(to < 0)).size:
                names = np.unique(state[missing] * 256 + data[start[missing] + i])
                for name in names:
                    self._make(int(name) >> 8, int(name) & 255, int(self.columns[int(name) & 255]))
                to = self.next[state[:live], column]
            count[:live] += self.emit[state[:live], column]
            state[:live] = to
            i += 1
        back = np.empty(len(start), np.int64)
        back[order] = count
        return out, back

    def walk(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Token counts of the pieces ``data[start:start + size]``."""
        out = np.empty(len(start), np.int64)
        short = np.flatnonzero(size <= LONG)
        ends, out[short] = self._walked(data, start[short], size[short], [FIRST] * len(short))
        out[short] += np.array([e[-1][2] for e in ends], np.int64)
        for i in np.flatnonzero(size > LONG):
            out[i] = self._long(data[start[i]:start[i] + size[i]])
        return out

    def _long(self, data: np.ndarray) -> int:
        """Token count of one long piece, from the maps of its chunks."""
        at = np.arange(0, len(data), CHUNK)
        size = np.minimum(CHUNK, len(data) - at)
        guess, _ = self._walked(data, at[1:] - WARM, np.full(len(at) - 1, WARM), [FIRST] * (len(at) - 1))
        maps: list[dict[tuple, tuple[tuple, int]]] = [{} for _ in at]
        todo = list(enumerate([FIRST, *guess]))
        while todo:
            chunk = np.array([j for j, _ in todo])
            ends, counts = self._walked(data, at[chunk], size[chunk], [s for _, s in todo])
            for (j, s), end, n in zip(todo, ends, counts, strict=True):
                maps[j][s] = (end, int(n))
            todo = sorted({(j + 1, end) for (j, _), end in zip(todo, ends, strict=True) if j + 1 < len(at) and end not in maps[j + 1]},
                          key=lambda x: x[0])
        # the maps as arrays: from the i-th state of a chunk to which state of the next, with how many tokens
        places = [{s: i for i, s in enumerate(m)} for m in maps]
        last = list({e for e, _ in maps[-1].values()})
        places.append({s: i for i, s in enumerate(last)})
        width = max(len(m) for m in maps)
        to, add = np.zeros((len(at), width), np.int64), np.zeros((len(at), width), np.int64)
        for j, m in enumerate(maps):
            for i, (end, n) in enumerate(m.values()):
                to[j, i], add[j, i] = places[j + 1][end], n
        while len(to) > 1:                                 # compose neighbours, all pairs at once
            even = len(to) // 2 * 2
            first, second = to[0:even:2], to[1:even:2]
            joined = np.take_along_axis(second, first, 1), add[0:even:2] + np.take_along_axis(add[1:even:2], first, 1)
            to, add = np.vstack([joined[0], to[even:]]), np.vstack([joined[1], add[even:]])
        end = places[0][FIRST]
        return int(add[0, end]) + last[to[0, end]][-1][2]

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Token counts of pieces; pieces seen before are looked up by hash."""
        if not len(start):
            return np.zeros(0, np.int64)
        h = textscan.span_hash(textscan.prefix_sums(data, textscan.TABLE_EXACT), start, end)
        names, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        keys, counts = self.known
        at = np.minimum(np.searchsorted(keys, names), max(len(keys) - 1, 0))
        have = keys[at] == names if len(keys) else np.zeros(len(names), bool)
        out = np.zeros(len(names), np.int64)
        out[have] = counts[at[have]]
        new = np.flatnonzero(~have)
        if len(new):
            out[new] = self.walk(data, start[first[new]], (end - start)[first[new]])
            if len(keys) + len(new) > self.max_known:
                keys, counts = keys[:0], counts[:0]
            keys, counts = np.r_[keys, names[new]], np.r_[counts, out[new].astype(np.int32)]
            order = np.argsort(keys)
            self.known = keys[order], counts[order]
        return out[inverse]


def _byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def compile_tokenizer(spec: str) -> dict:
    """Checks that the file is of the supported kind; what the workers need."""
    d = json.loads(spec)
    splitter = d.get("pre_tokenizer") or {}
    if d["model"]["type"] != "BPE" or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") \
            or not splitter.get("use_regex", True) or d.get("normalizer") or d["model"].get("ignore_merges"):
        raise ValueError("only byte-level BPE files with the ByteLevel splitter are supported")
    odd = [t["content"] for t in d.get("added_tokens", []) if t.get("lstrip") or t.get("rstrip") or t.get("single_word")]
    if odd:
        raise ValueError(f"added tokens that take in blanks or want whole words are not supported: {odd}")
    return {"digest": hashlib.sha256(spec.encode()).hexdigest(), "model": {"merges": d["model"]["merges"]},
            "special": sorted(t["content"] for t in d.get("added_tokens", []))}


def _machine(compiled: dict) -> tuple:
    """One machine per worker process, whatever number of tasks it runs."""
    cache, key = textscan.process_cache(), ("tokenizer", compiled["digest"])
    if key not in cache:
        cache[key] = (_classes(), *_splitter(), Encoder(compiled["model"]))
    return cache[key]


def count_batch(data: np.ndarray, offsets: np.ndarray, compiled: dict) -> np.ndarray:
    """Tokens of every text of a batch."""
    classes, move, mark, encoder = _machine(compiled)
    raw = data.tobytes()
    total = np.zeros(len(offsets) - 1, np.int64)
    # segments: texts, cut at special tokens
    cuts, owner = [offsets[:-1]], [np.arange(len(offsets) - 1)]
    skips: list[tuple[int, int]] = []
    for special in compiled["special"]:
        s, at = special.encode(), -1
        while (at := raw.find(s, at + 1)) >= 0:
            doc = int(np.searchsorted(offsets, at, "right")) - 1
            if at + len(s) <= offsets[doc + 1]:
                skips.append((at, at + len(s)))
                total[doc] += 1
                at += len(s) - 1
    lead = (data & 0xC0) != 0x80
    begin = np.flatnonzero(lead)                 # byte place of every character
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    symbols = classes[points]
    # END goes before every text and around special tokens
    breaks = np.unique(np.r_[offsets, [x for s in skips for x in s]].astype(np.int64))
    place = np.searchsorted(begin, breaks)
    symbols = np.insert(symbols, place, END)
    starts = piece_starts(symbols, move, mark)
    real = symbols != END
    starts = starts[real]
    edge = place[place < len(begin)]
    starts[edge] = True
    at = begin[starts]
    end = np.r_[at[1:], len(data)] if len(at) else at
    if skips:
        first, last = (np.array(sorted(x[k] for x in skips)) for k in (0, 1))
        inside = at < np.r_[-1, last][np.searchsorted(first, at, "right")]
        at, end = at[~inside], end[~inside]
    counts = encoder.count(data, at, end)
    np.add.at(total, np.searchsorted(offsets, at, "right") - 1, counts)
    return total


def _count(compiled):
    def run(batches):
        for batch in textscan.chunks(batches, "text", 1 << 20):
            data, offsets = textscan.as_buffer(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(count_batch(data, offsets, compiled.value))],
                names=["doc_id", "n_bytes", "n_tokens"])
    return run


def count_tokens(documents: DataFrame, tokenizer_file: str, *, doc_id: str = "doc_id", text: str = "text",
                 limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; a narrow pass over the table."""
    with open(tokenizer_file, encoding="utf-8") as f:
        compiled = compile_tokenizer(f.read())
    # a tokenizer's merges: a few MB, whatever the size of the data
    held = documents.sparkSession.sparkContext.broadcast(compiled)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = rows.mapInArrow(_count(held), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
