"""Token counts from a byte-level BPE compiled to a deterministic transducer.

The states of the transducer are what the merges can still depend on after a prefix of a word: for
every place from which a token may yet grow, the token that ends there and the tokens counted since.
A transition on a byte is annotated with the change in emitted tokens, which sums to the count. States
and transitions are made when first met; their number is finite, and the table is emptied at a bound.

A text is cut into chunks anywhere. The map of a chunk takes the state before it to the state and
count after it: its head, up to the first word start, depends on the state before, the rest doesn't.
All chunks run in step, first the rests, then the heads, each from the state it is likely entered in: that
after the rest before it, or after the whole chunk before it when that holds no word start. The maps, known at
that state each, are then composed by a parallel prefix scan. Where one is entered in another state,
its map is worked out there too and the scan is run again; merges forget what is far behind, so that is rare.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import small_batches
from tidemark.llm.packing import GAP, STRIDE, byte_alphabet

CHUNK = 512
BLOCK = 2 << 20
TABLE = 21  # the transition table has 2**TABLE places
_EMPTY = np.int64(-1)


@cache
def char_classes() -> np.ndarray:
    """For every code point 1 letter, 2 number, 3 white space or 0."""
    import regex

    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, text):
            out[[ord(c) for c in found.group()]] = kind
    return out


def word_starts(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the words of the tokenizer's pattern start; texts start at `begins`. A word is: a contraction
    (an apostrophe with s, t, re, ve, m, ll or d, where a word starts), or letters, numbers or other
    characters, each with a space before them if there is one, or white space but for its last
    character where something follows."""
    if not len(points):
        return np.zeros(0, bool)
    kind, first = char_classes()[points], np.zeros(len(points) + 4, bool)
    first[begins] = True
    first[len(points) :] = True
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[0], before[1:] = 9, kind[:-1]
    after[-1], after[:-1] = 3, kind[1:]
    last = first[1 : len(points) + 1]
    space = kind == 3
    joined = np.zeros(len(points), bool)
    joined[1:] = points[:-1] == 32
    start = np.where(space, (before != 3) | ((after != 3) & ~last), ~joined & (before != kind)) | first[: len(points)]
    for i in np.flatnonzero((points == 39) & start):
        tail = "".join(map(chr, points[i + 1 : i + 3]))
        size = 1 if tail[:1] in ("s", "t", "m", "d") and tail else 2 if tail in ("re", "ve", "ll") else 0
        if size and not first[i + 1 : i + 1 + size].any():
            start[i + 1 : i + 1 + size] = False
            start[i + 1 + size : i + 2 + size] = True
    return start


class TableFull(Exception):
    """More transitions were needed at once than the table holds."""


def scan(first: np.ndarray, enter: np.ndarray, leave: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefixes of maps composed in a logarithmic number of rounds: (the count up to and with each chunk, and
    whether all maps from the one marked `first` on met: each was entered in the state the one before it left)."""
    total, whole = count.copy(), np.ones(len(count), bool)
    whole[1:] = first[1:] | (enter[1:] == leave[:-1])
    done, step = first.copy(), 1  # done: the prefix reaches back to its first chunk
    while step < len(count) and not done.all():
        on = np.flatnonzero(~done[step:]) + step
        add, ok, end = total[on - step], whole[on - step], done[on - step]
        total[on] += add
        whole[on] &= ok
        done[on] = end
        step *= 2
    return total, whole


class Transducer:
    """The merges of one tokenizer file as transitions between numbered states; 0 is a word's start."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["normalizer"] is not None or spec["pre_tokenizer"] != {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
        } or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        alphabet = byte_alphabet()
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        added = {t["content"] for t in spec["added_tokens"]}
        read = lambda token: bytes(map(alphabet.__getitem__, token))
        self.tokens = {read(t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.spelled = {i: t for t, i in self.tokens.items()}
        self.ranks = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[read(left), read(right)] = rank
        self.next_node: dict[int, int] = {}  # the trie of all tokens: node << 8 | byte
        self.node_token, self.inner = [-1], [True]
        for token, number in self.tokens.items():
            node = 0
            for byte in token:
                self.inner[node] = True
                down = self.next_node.get(node << 8 | byte)
                if down is None:
                    down = self.next_node[node << 8 | byte] = len(self.node_token)
                    self.node_token.append(-1)
                    self.inner.append(False)
                node = down
            self.node_token[node] = number
        self.clear()

    def clear(self) -> None:
        # A state is a tuple of places: node << 32 | token before + 1 << 12 | tokens since + 2048.
        self.states, self.numbers, self.follows = [(2048,)], {(2048,): 0}, {}
        self.keys = np.full(1 << TABLE, _EMPTY)
        self.to, self.emits = (np.zeros(1 << TABLE, np.int32) for _ in range(2))
        self.used = 0

    def merge(self, word: bytes) -> list[bytes]:
        """The tokens of a word by the merges themselves."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            found = [(self.ranks.get(p, 1 << 40), p) for p in zip(parts, parts[1:], strict=False)]
            rank, pair = min(found)
            if rank == 1 << 40:
                break
            out, i = [], 0
            while i < len(parts):
                if parts[i : i + 2] == list(pair):
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart: exactly the tokenizations of which all neighbours do occur."""
        known = self.follows.get(left << 20 | right)
        if known is None:
            a, b = self.spelled[left], self.spelled[right]
            known = self.follows[left << 20 | right] = self.merge(a + b) == [a, b]
        return known

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """The state after a byte, and the change in the number of tokens."""
        live, token, count = [], -1, 0
        for place in self.states[state]:
            before, tokens = (place >> 12 & 0xFFFFF) - 1, (place & 4095) - 2048
            node = self.next_node.get(place >> 32 << 8 | byte, -1)
            if node < 0:
                continue
            if token < 0 <= (ends := self.node_token[node]) and (before < 0 or self.may_follow(before, ends)):
                token, count = ends, tokens + 1
            if self.inner[node]:
                live.append((node, before, tokens))
        state = (*(node << 32 | before + 1 << 12 | tokens - count + 2048 for node, before, tokens in live), token + 1 << 12 | 2048)
        return self.number(state), count

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where the transitions of state << 8 | byte stand in the table; missing ones are made."""
        mask = (1 << TABLE) - 1
        at = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE)).astype(np.int64)
        open_ = np.flatnonzero(self.keys[at] != keys)
        while len(open_):
            free = open_[self.keys[at[open_]] == _EMPTY]
            if len(free):
                for i in free[np.unique(keys[free], return_index=True)[1]].tolist():
                    place, key = int(at[i]), int(keys[i])
                    while self.keys[place] != _EMPTY and self.keys[place] != key:
                        place = (place + 1) & mask
                    if self.keys[place] == _EMPTY:
                        self.keys[place] = key
                        self.to[place], self.emits[place] = self.step(key >> 8, key & 255)
                        self.used += 1
                        if self.used > (1 << TABLE) * 0.8:
                            raise TableFull
            open_ = open_[self.keys[at[open_]] != keys[open_]]
            at[open_] = (at[open_] + 1) & mask
            open_ = open_[self.keys[at[open_]] != keys[open_]]
        return at

    def run(self, raw: np.ndarray, new: np.ndarray, low: np.ndarray, high: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States and counts after raw[low:high] of many chunks in step; a word start resets the state."""
        order = np.argsort(low - high, kind="stable")
        low, size, state = low[order], (high - low)[order], state[order].astype(np.int64)
        count = np.zeros(len(low), np.int64)
        for t in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -t))  # chunks longer than t
            at = low[:n] + t
            state[:n][new[at]] = 0
            place = self.places(state[:n] << 8 | raw[at])
            state[:n] = self.to[place]
            count[:n] += self.emits[place]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def count(self, pieces: list[str]) -> np.ndarray:
        """The tokens of every piece, each a whole number of words."""
        text = "".join(pieces)
        raw = np.frombuffer(text.encode(), np.uint8)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        chars = np.cumsum([0, *map(len, pieces)])
        wide = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).astype(np.int64)
        byte = np.concatenate(([0], np.cumsum(wide)))
        begins = chars[:-1][np.diff(chars) > 0]
        new = np.zeros(len(raw) + 1, bool)
        new[byte[:-1][word_starts(points, begins)]] = True
        at = byte[chars]
        if self.used > (1 << TABLE) // 2 or len(self.states) > 500_000:
            self.clear()
        per = -(-np.diff(at) // CHUNK)
        owner = np.repeat(np.arange(len(pieces)), per)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        low = at[owner] + nth * CHUNK
        high = np.minimum(low + CHUNK, at[owner + 1])
        counts, spans, carried = np.zeros(len(low), np.int64), [(0, len(low))], self.states[0]
        while spans:
            a, b = spans.pop()
            try:
                counts[a:b], carried = self.span(raw, new, low[a:b], high[a:b], nth[a:b] == 0, carried)
            except TableFull:  # empty it, and take fewer chunks at a time
                self.clear()
                spans += [((a + b) // 2, b), (a, (a + b) // 2)] if b - a > 1 else [(a, b)]
        return np.bincount(owner, counts, len(pieces)).astype(np.int64)

    def span(
        self, raw: np.ndarray, new: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray, carried: tuple,
    ) -> tuple[np.ndarray, tuple]:
        """The tokens of consecutive chunks, of which the `first` ones begin a piece, and the state after the
        last one; the chunk before them left the state `carried`. States go in and out spelled out, as the table may be emptied between."""
        if not len(low):
            return np.zeros(0, np.int64), carried
        starts = np.flatnonzero(new)
        word = np.searchsorted(starts, low)  # the first word start in each chunk, or behind it
        middle = np.minimum(np.append(starts, len(raw))[word], high)
        open_ = middle == high  # without a word start: the head is all of it
        zero = np.zeros(len(low), np.int64)
        leaves, counts = self.run(raw, new, middle, high, zero)
        guess = leaves.copy()
        guess[open_], _ = self.run(raw, new, low[open_], high[open_], zero[open_])
        enter = np.concatenate(([self.number(carried)], guess[:-1]))
        enter[first] = 0
        heads, todo = np.zeros(len(low), np.int64), np.flatnonzero(middle > low)
        while len(todo):
            ends, heads[todo] = self.run(raw, new, low[todo], middle[todo], enter[todo])
            leaves[todo] = np.where(open_[todo], ends, leaves[todo])
            _, whole = scan(first | (np.arange(len(low)) == 0), enter, leaves, counts + heads)
            todo = np.flatnonzero(~whole)
            todo = todo[enter[todo] != leaves[todo - 1]]
            enter[todo] = leaves[todo - 1]
        return counts + heads, self.states[int(leaves[-1])]

    def number(self, state: tuple) -> int:
        """The number of a state that is spelled out."""
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]


@cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


def _pieces(special: re.Pattern, text: str) -> Iterator[str]:
    """A text without its special strings, cut before white space that follows something else."""
    for part in special.split(text):
        low = 0
        while low < len(part):
            gap = GAP.search(part, low + STRIDE) if len(part) - low > STRIDE else None
            high = gap.start() if gap else len(part)
            yield part[low:high]
            low = high


def count_tokens(path: str, column: pa.Array) -> np.ndarray:
    """The tokens of every row of a string column; a null row has none."""
    machine, out = transducer(path), np.zeros(len(column), np.int64)
    rows: list[int] = []
    pieces: list[str] = []
    size = 0
    for row, value in enumerate(column):
        text = value.as_py() or ""
        out[row] += len(machine.special.findall(text))
        for piece in _pieces(machine.special, text):
            if size + len(piece) > BLOCK and pieces:
                np.add.at(out, rows, machine.count(pieces))
                rows, pieces, size = [], [], 0
            rows.append(row)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        np.add.at(out, rows, machine.count(pieces))
    return out


def token_counts(docs: DataFrame, tokenizer: str, *, limit: int = 512, text_col: str = "text") -> DataFrame:
    """`docs` with n_bytes, n_tokens and over_limit added (columns of those names are replaced).

    n_tokens is what the library of the `tokenizer` file (a byte-level BPE) gives without added begin and
    end; special strings inside a text count one each, as they do there by default. n_bytes is the UTF-8
    length and over_limit says n_tokens > `limit`. A null text counts as empty: 0 bytes, 0 tokens. Every
    row is counted whole, repeated ones too; other columns stay; an empty table stays empty.
    """

    @F.arrow_udf("long")
    def counted(text: pa.Array) -> pa.Array:
        return pa.array(count_tokens(tokenizer, text))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return small_batches(docs).withColumns({"n_bytes": F.octet_length(text).cast("long"), "n_tokens": counted(text)}).withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
