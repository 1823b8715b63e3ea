"""Secret scans: patterns for known forms, and two character Markov models for the rest.

One model is of random strings, the other of ordinary identifiers and words. A long run of key characters
is a secret when the random model explains it better by a margin, as a log-likelihood ratio.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import small_batches, tidy
from tidemark.llm.order import unused
from tidemark.llm.texts import BLOCK, batch_bytes

#: Fixed values of the result's contract: patterns and least lengths of the known forms, in their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "markov")

HINTS = ("password", "passwd", "secret", "token", "api")
RUN = 20  # characters of the shortest run the models judge
BACKOFF = 0.1  # share of the ordinary model that knows kinds of characters alone
NAMED = 5  # words of an identifier that the ordinary model is trained on
DIFFERENT = 8  # different characters in it at least: rulers and padding aren't secrets
_RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{RUN},}}", re.A)
_WORD = re.compile(r"[A-Za-z0-9_-]+", re.A)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.full(128, -1, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_KEYLIKE = np.zeros(256, bool)
_KEYLIKE[[ord(c) for c in ALPHABET + "."]] = True


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the known forms, leftmost and without overlap within a kind, by start and kind."""
    low = text.lower()
    found = []
    if any(hint in low for hint in HINTS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST["access"]]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]] if _long_run(text) else []
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def _long_run(text: str) -> bool:
    raw = np.frombuffer(text.encode("ascii", "replace"), np.uint8)
    return bool(_runs(raw, np.array([0, len(raw)])).size)


def _runs(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where runs of RUN or more key characters begin; a run ends with its row, rows begin at `at`."""
    key = np.concatenate(([False], _KEYLIKE[raw], [False]))
    first = np.zeros(len(raw) + 1, bool)
    first[at] = True
    start = np.flatnonzero(key[1:-1] & (~key[:-2] | first[:-1]))
    end = np.flatnonzero(key[1:-1] & (~key[2:] | first[1:])) + 1
    return start[end - start >= RUN]


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratios, random over ordinary: of a first character, of a character after another."""

    first: np.ndarray
    then: np.ndarray
    margin: float  # least ratio per character

    def ratio(self, run: str) -> float:
        code = _CODE[np.frombuffer(run.encode("ascii"), np.uint8)]
        return float(self.first[code[0]] + self.then[code[:-1], code[1:]].sum()) / len(code)


def identifiers(words: list[str]) -> list[str]:
    """Words as they stand in programs and paths: runs of NAMED of them in every style of joining."""
    out = []
    for at in range(0, len(words), NAMED):
        run = [w.lower() for w in words[at : at + NAMED]]
        high = [w[:1].upper() + w[1:] for w in run]
        snake = "_".join(run)
        out += ["".join(high), run[0] + "".join(high[1:]), snake, snake.upper(), "-".join(run), "/".join(run), "".join(run)]
    return out


def _train_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bigram counts of labelled strings: 1 what the known forms hold, 0 the words outside of them."""
    n = len(ALPHABET) + 1  # the last stands for a string's begin
    counts = np.zeros((2, n, n), np.int64)
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py()
            spans = base_spans(text)
            held, at = [], 0
            for low, kind, high in spans:
                body = text[max(low, at) : high]
                held.append(ASSIGN.match(body).group(2) if kind == "assign" and ASSIGN.match(body) else body)
                at = max(at, high)
            at, rest = 0, []
            for low, _, high in spans:
                rest.append(text[at:low] if low > at else "")
                at = max(at, high)
            rest.append(text[at:])
            words = [w for w in _WORD.findall(" ".join(rest)) if len(w) < RUN]  # a longer one has no label
            letters = [w for w in words if w.isalpha()]
            for label, strings in ((1, held), (0, words + identifiers(letters))):
                raw = np.frombuffer("\n".join(["", *strings]).encode("ascii", "replace"), np.uint8)
                code = np.where(raw == 10, n - 1, _CODE[np.minimum(raw, 127)])
                pair = (code[:-1] >= 0) & (code[1:] >= 0) & (code[1:] < n - 1)
                counts[label] += np.bincount(code[:-1][pair] * n + code[1:][pair], minlength=n * n).reshape(n, n)
    label, left, right = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(v.astype(np.int32)) for v in (label, left, right)] + [pa.array(counts[label, left, right])], names=["label", "a", "b", "n"]
    )


def _backed_off(counts: np.ndarray) -> np.ndarray:
    """Shares of the next character, which leave BACKOFF to any one of its kind as often as that kind comes after
    this one's: letter pairs of names the sample lacks aren't taken for random."""
    kind = np.array([0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3 for c in ALPHABET] + [4])
    member = (kind[:, None] == np.arange(5)).astype(float)
    kinds = member.T @ counts @ member[:-1, :4] + 1
    like = member @ (kinds / kinds.sum(1, keepdims=True)) @ (member[:-1, :4] / member[:, :4].sum(0)).T
    seen = counts + 0.05
    return (1 - BACKOFF) * seen / seen.sum(1, keepdims=True) + BACKOFF * like


def fit(docs: DataFrame, *, text_col: str = "text", key_col: str = "doc_id", sample: int = 20_000, margin: float = 0.75) -> Model:
    """Learn both models from about `sample` rows, chosen by a hash of `key_col` (all where there are fewer).

    Labelled strings are those the known forms hold (random), and the words of fewer than RUN characters
    outside of them, alone and joined to identifiers in every usual style (ordinary), backed off to kinds of
    characters.
    A thousand uniform characters are added to the random ones, so a corpus without secrets gives a model too;
    without any text nothing is called random.
    Counts are summed over tasks; the driver sees two tables of 68 by 68 numbers.
    """
    rows = small_batches(docs).where(F.col(text_col).isNotNull())
    share = min(1.0, sample / max(1, rows.count()))
    chosen = rows.where(F.pmod(F.xxhash64(F.lit(21), F.col(key_col)), F.lit(1_000_000)) < int(np.ceil(share * 1_000_000)))
    found = (
        chosen.select(F.col(text_col).cast("string")).mapInArrow(tidy(_train_counts), "label int, a int, b int, n long")
        .groupBy("label", "a", "b").agg(F.sum("n").alias("n")).toArrow()
    )
    n = len(ALPHABET)
    counts = np.zeros((2, n + 1, n + 1))
    counts[found["label"].to_numpy(), found["a"].to_numpy(), found["b"].to_numpy()] = found["n"].to_numpy()
    counts = counts[:, :, :n]
    counts[0] = _backed_off(counts[0])
    counts[1] = 0.5 * counts[1] / max(counts[1].sum(), 1) * 1000 + 0.5 * 1000 / (n + 1) / n  # half seen, half uniform
    logs = np.log(counts / counts.sum(2, keepdims=True))
    ratio = logs[1] - logs[0]
    return Model(ratio[n], ratio[:n], margin)


def all_spans(text: str, model: Model | None) -> list[tuple[int, str, int]]:
    """The known forms and, where they leave a run uncovered, what the models call random."""
    spans = base_spans(text)
    if model is None or not _long_run(text):
        return spans
    more = [
        (m.start(), "markov", m.end()) for m in _RUN.finditer(text)
        if len(set(m.group())) >= DIFFERENT and model.ratio(m.group()) >= model.margin
        and not any(low < m.end() and m.start() < high for low, _, high in spans)
    ]
    return sorted(spans + more, key=lambda s: (s[0], KINDS.index(s[1])))


def spans_text(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{low}:{high}" for low, kind, high in spans)


def redact(text: str, spans: list[tuple[int, str, int]], mark: str) -> str:
    """The text with every stretch under a span, overlaps joined, replaced by the mark."""
    out, at = [], 0
    for low, _, high in spans:
        if low >= at:
            out += [text[at:low], mark]
        at = max(at, high)
    return "".join([*out, text[at:]])


def _suspects(column: pa.Array) -> np.ndarray:
    """Rows that can hold a span at all: a long run of key characters, or an assignment's word and sign."""
    raw, at = batch_bytes(column)
    out = np.zeros(len(column), bool)
    for low in range(0, len(raw), BLOCK):
        part = raw[low : low + BLOCK + RUN]  # a run over the block's end is long enough in one of the two
        inside = at[(at >= low) & (at <= low + len(part))] - low
        out[np.searchsorted(at, _runs(part, inside) + low, "right") - 1] = True
    for row, value in enumerate(column):
        if not out[row] and value.is_valid:
            text = value.as_py()
            if ":" in text or "=" in text:
                low = text.lower()
                out[row] = any(hint in low for hint in HINTS)
    return out


_FOUND = pa.struct([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_markov", pa.int64()),
                    ("base_sha256", pa.string()), ("spans", pa.string()), ("redacted", pa.string())])


def scan_secrets(docs: DataFrame, model: Model | None, *, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with n_assign, n_access, n_hex, n_markov, base_sha256, spans and redacted added (columns of
    those names are replaced).

    Spans are kind:start:end in code points, end exclusive, by start and then kind (assign, access, hex,
    markov), joined by commas; base_sha256 is the SHA-256 of the first three kinds' spans. A markov span is a
    run of RUN or more key characters, DIFFERENT ones among them, that touches no base span and that `model`
    calls random; without a model there are none. redacted is the text with all spans replaced by `mark`; null where nothing was found. A
    null text counts as empty. Texts are scanned whole; repeated rows are each scanned, other columns
    stay, an empty table stays empty.
    """

    @F.arrow_udf("n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string, redacted string")
    def scan(column: pa.Array) -> pa.Array:
        empty = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "", None)
        rows = []
        for value, suspect in zip(column, _suspects(column).tolist(), strict=True):
            spans = all_spans(text := value.as_py(), model) if suspect else []
            if not spans:
                rows.append(empty)
                continue
            kinds = [kind for _, kind, _ in spans]
            base = spans_text([s for s in spans if s[1] != "markov"])
            rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), spans_text(spans), redact(text, spans, mark)))
        columns = list(zip(*rows, strict=True)) or [()] * len(_FOUND)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], fields=list(_FOUND))

    names = [f.name for f in _FOUND]
    [own] = unused(docs, "_found")
    scanned = small_batches(docs).withColumn(own, scan(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return scanned.withColumns({name: F.col(f"{own}.{name}") for name in names}).drop(own)
