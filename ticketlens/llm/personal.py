"""Personal data: fixed patterns, and a character BiLSTM-CRF that adds spans.

Base spans are those of four fixed patterns (leftmost, not overlapping, per
kind; a match that fails its check is dropped).  The tagger (``tagger``) is
trained in numpy on labelled windows: base spans of a bounded sample of
documents, and spans written in other ways (telephone numbers without ``+``,
masked ``@`` and dots, other separators) put into windows of the same texts,
together with numbers that are no personal data.

Every document is cut into windows of ``WINDOW`` characters with half a window
of overlap.  A span must hold an anchor (a digit, ``@``, ``(at)`` or
``[at]`` in any case), so the windows around anchors are run, and the next ones
as long as a span goes on over their edge.  The decoded spans of all windows are
reconciled over the whole document: a span cut by a window's edge is joined with
its part in the next window.  Added spans of more than ``longest`` characters (a
parameter; ``LONGEST``, the longest address that can be mailed to) are none of
these kinds and not added.  An exact check
leaves out spans without the digits of their kind (Luhn for cards) and spans
that overlap a base span; of the rest the set of spans without overlap that has
the greatest sum of marginals is taken (weighted interval scheduling).  Base
spans always stay.

Defined results: NULL and empty texts have no span; offsets are code points;
a NULL id is returned as it is; rows that share an id are each searched.
Without any document to train on nothing is added.  An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import ready_workers
from ticketlens.llm.tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
WINDOW = 64
HIDDEN = 24
STEPS = 1000
BATCH = 48
RATE = 0.02
SAMPLE = 300
SAMPLE_CHARS = 20_000
EXAMPLES = 6000
MIN_MARGINAL = 0.9
LONGEST = 320
DECODE_BATCH = 256
RESULT_SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]|[(\[](?:at|AT|At|aT)[)\]]")
DIGIT = re.compile(r"[0-9]")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """The check of card numbers: every second digit from the right doubled, digit sums to a multiple of 10."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them; the part before ``@`` is walked back once, so long runs stay linear."""
    end, at = 0, text.find("@")
    while at >= 0:
        found = DOMAIN.match(text, at + 1)
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if found and start < at:
            yield start, found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them; a run of digits is tried from its beginning only."""
    end = 0
    for run in DIGITS.finditer(text):
        if run.start() >= end and (found := IP.match(text, run.start())):
            yield found.span()
            end = found.end()


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Base spans in order of start, then kind."""
    out: list[tuple[int, int, int]] = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(a, 1, b) for a, b in _ips(text) if all(map(_octet, text[a:b].split(".")))]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(DIGIT.findall(m.group())) <= 15]
    return [(KINDS[k], a, b) for a, k, b in sorted(out)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# --- the tagger's view of a text

_SYMBOLS = 100
PAD, LETTER, OTHER = 97, 98, 99


def symbols(text: str) -> np.ndarray:
    """ASCII characters as themselves, other letters and other characters as one symbol each."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    out = np.where((code >= 32) & (code < 127), code - 32, np.where(code < 32, 96, OTHER))
    for i in np.flatnonzero(code > 127).tolist():
        if text[i].isalpha():
            out[i] = LETTER
    return out


def _example(text: str, spans: list[Span], centre: int, rs: np.random.RandomState) -> tuple[np.ndarray, np.ndarray]:
    """One window around ``centre`` with its tags (0 outside, 2k + 1 first and 2k + 2 other characters of kind k)."""
    low = centre - rs.randint(4, WINDOW - 4)
    x, y = np.full(WINDOW, PAD), np.zeros(WINDOW, dtype=np.int64)
    a, b = max(0, low), min(len(text), low + WINDOW)
    x[a - low : b - low] = symbols(text[a:b])
    for kind, s, e in spans:
        k = KINDS.index(kind)
        for i in range(max(s, low), min(e, low + WINDOW)):
            y[i - low] = 2 * k + (1 if i == s else 2)
    return x, y


def _digits(rs: np.random.RandomState, n: int) -> str:
    return "".join(map(str, rs.randint(0, 10, n)))


def _card(rs: np.random.RandomState, n: int) -> str:
    body = _digits(rs, n - 1)
    return next(body + d for d in "0123456789" if luhn(body + d))


def _written(rs: np.random.RandomState, words: list[str]) -> tuple[str | None, str]:
    """(kind, text) of a span as people write it; kind None for numbers that are no personal data."""
    word = lambda: re.sub(r"[^A-Za-z]", "", words[rs.randint(len(words))]).lower() or "name"
    kind = rs.randint(0, 6)
    if kind == 0:
        at = ("@", "(at)", "[at]", " (at) ", " [at] ", " @ ", "(AT)", "[AT]", " [AT] ")[rs.randint(9)]
        dot = (".", ".", ".", " dot ", "(dot)")[rs.randint(5)]
        left = (word(), f"{word()}.{rs.randint(0, 99)}", f"{word()}_{word()}", f"{word()}.{word()}", f"{word()}-{word()[:1]}", f"{word()[:1]}.{word()}+{word()}", f"{word()}{rs.randint(0, 99)}")[rs.randint(7)]
        label = lambda: (word(), f"{word()}{rs.randint(0, 10)}", f"{word()}-{word()}")[rs.randint(3)]
        ending = ("com", "org", "net", "".join("abcdefghijklmnopqrstuvwxyz"[i] for i in rs.randint(0, 26, rs.randint(2, 5))))[rs.randint(4)]
        return "email", left + at + dot.join([*(label() for _ in range(rs.randint(1, 3))), ending])
    if kind == 1:
        dot = (".", ".", "[.]", " . ")[rs.randint(4)]
        return "ip", dot.join(str(x) for x in rs.randint(0, 256, 4))
    if kind == 2:
        number = _card(rs, rs.randint(14, 20))
        gap = ("", "", " ", "-", ".", "/")[rs.randint(6)]
        return "card", gap.join(number[i : i + 4] for i in range(0, len(number), 4))
    if kind == 3:
        a, b, c = _digits(rs, 3), _digits(rs, 3), _digits(rs, 4)
        forms = (f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{rs.randint(10, 99)} {a} {b} {c}", f"{a}.{b}.{c}", f"00{rs.randint(10, 99)} {a} {b} {c}")
        return "phone", forms[rs.randint(len(forms))]
    forms = (
        "".join("0123456789abcdef"[i] for i in rs.randint(0, 16, rs.randint(8, 48))),
        f"{rs.randint(0, 9)}.{rs.randint(0, 20)}",
        f"{rs.randint(0, 9)}.{rs.randint(0, 20)}.{rs.randint(0, 99)}",
        f"{rs.randint(1900, 2050)}-{rs.randint(1, 13):02d}-{rs.randint(1, 29):02d}",
        f"{rs.randint(0, 24):02d}:{rs.randint(0, 60):02d}",
        _digits(rs, rs.randint(1, 9)),
        _digits(rs, rs.randint(20, 32)),
        f"{rs.randint(1, 999)},{_digits(rs, 3)}.{_digits(rs, 2)}",
        f"#{_digits(rs, 5)}",
    )
    return None, forms[rs.randint(len(forms))]


def train_tagger(texts: list[str], steps: int = STEPS, examples: int = EXAMPLES, seed: int = 5) -> Tagger | None:
    """Fit on windows of the texts: base spans, written spans, other numbers, plain text."""
    texts = [t for t in texts if t.strip()]
    if not texts:
        return None
    rs = np.random.RandomState(seed)
    windows = []
    for t in texts:
        found = base_spans(t)
        for _, a, b in found[:20]:
            windows.append(_example(t, found, (a + b) // 2, rs))
        for m in list(ANCHOR.finditer(t))[:200:20]:
            windows.append(_example(t, found, m.start(), rs))
    rs.shuffle(windows)
    windows = windows[: examples // 2]
    words = [w for t in texts for w in t.split()[:200]]
    while len(windows) < examples:
        t = texts[rs.randint(len(texts))]
        cut = rs.randint(0, len(t) + 1)
        left, right = t[max(0, cut - WINDOW) : cut], t[cut : cut + WINDOW]
        kind, written = _written(rs, words)
        mark = ("", ",", ".", "$$$", ")", ";")[rs.randint(6)]
        left += ("", " ", " ", " ", "\n", " (")[rs.randint(6)] if not left or not left[-1].isalnum() else " "
        whole = left + written + mark + " " + right.lstrip()
        spans = [(k, a, b) for k, a, b in base_spans(whole) if b <= len(left) or a >= len(left) + len(written)]
        if kind:
            spans.append((kind, len(left), len(left) + len(written)))
        elif base_spans(written):
            continue
        windows.append(_example(whole, spans, len(left) + len(written) // 2, rs))
    x, y = np.stack([w[0] for w in windows]), np.stack([w[1] for w in windows])
    tagger = Tagger.new(_SYMBOLS, 2 * len(KINDS) + 1, HIDDEN, seed)
    tagger.train(x, y, steps, BATCH, RATE, seed)
    return tagger


def _spans_of(tags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(kind, first, after the last) of runs of one kind's tags."""
    i, n = 0, len(tags)
    while i < n:
        if tags[i] == 0:
            i += 1
            continue
        k, j = (int(tags[i]) - 1) // 2, i + 1
        while j < n and tags[j] == 2 * k + 2:
            j += 1
        yield k, i, j
        i = j


def plausible(kind: str, text: str) -> bool:
    """The exact check of an added span."""
    digits = "".join(DIGIT.findall(text))
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s?(?:@|[(\[]at[)\]])\s?[A-Za-z0-9-]+(?:(?:\.|\s?dot\s|\(dot\))[A-Za-z0-9-]+)+", text, re.I | re.A))
    if kind == "ip":
        parts = re.split(r"\s?\[?\.\]?\s?", text)
        return len(parts) == 4 and all(p.isdigit() and p.isascii() and _octet(p) for p in parts)
    if kind == "card":
        return bool(re.fullmatch(r"[0-9](?:[ ./-]?[0-9])+", text)) and 14 <= len(digits) <= 19 and luhn(digits)
    return bool(re.fullmatch(r"[+(]?[0-9][ ().0-9-]+[0-9]", text)) and 10 <= len(digits) <= 15 and any(c in " (-." for c in text)


def reconciled(found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Of (start, end, kind, weight) the spans without overlap of the greatest total weight."""
    rows = sorted({(b, a, k): w for a, b, k, w in sorted(found, key=lambda r: r[3])}.items())
    ends: list[int] = []
    best: list[tuple[float, int]] = [(0.0, -1)]  # over the first i rows: weight, last row taken
    before: list[int] = []
    for i, ((b, a, _), w) in enumerate(rows):
        low = int(np.searchsorted(ends, a, side="right"))
        before.append(low)
        ends.append(b)
        taken = best[low][0] + w
        best.append((taken, i) if taken > best[-1][0] else best[-1])
    out, i = [], len(rows)
    while i and best[i][1] >= 0:
        row = best[i][1]
        (b, a, k), _ = rows[row]
        out.append((a, b, k))
        i = before[row]
    return out[::-1]


# first character, character after the last, kind, marginals, cut on the left, cut on the right
Piece = tuple[int, int, int, np.ndarray, bool, bool]


def joined_pieces(pieces: dict[tuple[int, int], list[Piece]], n: int, longest: int = LONGEST) -> list[list[tuple[int, int, int, float]]]:
    """(start, end, kind, weight) of the whole spans of each text; ``pieces`` by (text, window).

    A piece cut on the right goes on in the next window's piece of its kind
    that overlaps it; of two marginals of a character the greater one counts.
    """
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in range(n)]
    going_on: list[Piece] = []
    previous = (-1, 0)
    for i, w in sorted(pieces):
        if previous != (i, w - 1):
            going_on = []
        whole = [p for p in pieces[i, w] if not p[4]]
        for first, end, kind, held, _, _ in going_on:
            for a, b, k, own, _, cut in pieces[i, w]:
                if k == kind and first <= a < end <= b and b - first <= longest:
                    both = np.concatenate([held, own[end - a :]])
                    both[a - first : end - first] = np.maximum(held[a - first :], own[: end - a])
                    whole.append((first, b, kind, both, False, cut))
        going_on = [p for p in whole if p[5]]
        for a, b, k, weights, _, cut in whole:
            weight = float(weights.mean())
            if not cut and weight >= MIN_MARGINAL:
                found[i].append((a, b, k, weight))
        previous = (i, w)
    return found


class Finder:
    """Base and added spans of texts, the windows of many texts decoded together."""

    def __init__(self, tagger: Tagger | None, longest: int = LONGEST) -> None:
        self.tagger, self.longest = tagger, longest

    def find(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """(base, added) of each text."""
        base = [base_spans(t) for t in texts]
        pieces: dict[tuple[int, int], list[Piece]] = {}
        if self.tagger is not None:
            half = WINDOW // 2
            todo = {(i, w) for i, t in enumerate(texts) for m in ANCHOR.finditer(t) for w in (m.start() // half - 1, m.start() // half)}
            for _ in range(1 + self.longest // half):
                new = sorted(todo - pieces.keys())
                for a in range(0, len(new), DECODE_BATCH):
                    self._decode(texts, new[a : a + DECODE_BATCH], pieces)
                todo = {(i, w + step) for i, w in new for p in pieces[i, w] for step, cut in ((-1, p[4]), (1, p[5])) if cut}
        found = joined_pieces(pieces, len(texts), self.longest)
        out = []
        for t, own, more in zip(texts, base, found):
            starts, ends = (np.array([s[i] for s in own], dtype=np.int64) for i in (1, 2))
            fit = [
                (a, b, k, w)
                for a, b, k, w in more
                if ANCHOR.search(t, a, b) and not ((starts < b) & (ends > a)).any() and plausible(KINDS[k], t[a:b])
            ]
            out.append((own, [(KINDS[k], a, b) for a, b, k in reconciled(fit)]))
        return out

    def _decode(self, texts: list[str], windows: list[tuple[int, int]], pieces: dict[tuple[int, int], list[Piece]]) -> None:
        x = np.full((len(windows), WINDOW), PAD)
        for row, (i, w) in enumerate(windows):
            low = w * (WINDOW // 2)
            a, b = max(0, low), min(len(texts[i]), low + WINDOW)
            x[row, a - low : b - low] = symbols(texts[i][a:b])
            pieces[i, w] = []
        tags, marginal = self.tagger.decode(x)
        for row in np.flatnonzero(tags.any(axis=1)).tolist():
            i, w = windows[row]
            low, size = w * (WINDOW // 2), len(texts[i])
            for k, a, b in _spans_of(tags[row]):
                first, last = low + a, low + b
                if first >= 0 and last <= size:
                    pieces[i, w].append((first, last, k, marginal[row, a:b], a == 0 and low > 0, b == WINDOW and low + WINDOW < size))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Tagger | None:
    """Fit on about ``sample`` documents, half of them with a digit or ``@`` (twice that is the bound)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.where(F.length("text").between(1, SAMPLE_CHARS)).withColumn("marked", F.col("text").rlike("[0-9@]"))
    sizes = {r["marked"]: r["count"] for r in rows.groupBy("marked").count().collect()}
    rank = F.pmod(F.xxhash64(F.lit(5), "id", "text"), F.lit(1 << 30))
    chosen = F.lit(False)
    for marked, n in sorted(sizes.items()):
        chosen = chosen | ((F.col("marked") == F.lit(marked)) & (rank < int(min(1.0, sample / 2 / n) * (1 << 30)) + 1))
    picked = rows.where(chosen).withColumn("rank", rank).orderBy("rank", "id", F.xxhash64("text")).limit(2 * sample).collect()
    return train_tagger([r["text"] for r in sorted(picked, key=lambda r: (r["rank"], r["text"]))])


def personal_data(
    docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST
) -> DataFrame:
    """doc_id, counts of base spans by kind, the base spans' digest, all spans, number of added spans."""
    spark = docs.sparkSession
    ready_workers(spark)
    shared = spark.sparkContext.broadcast(tagger)  # fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value, longest)
        order = {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            found = finder.find([t or "" for t in batch.column(1).to_pylist()])
            counts = [[sum(k == kind for k, _, _ in base) for base, _ in found] for kind in KINDS]
            digest = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            spans = [joined(sorted(base + added, key=lambda s: (s[1], order[s[0]]))) for base, added in found]
            yield pa.record_batch(
                [
                    batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digest, pa.string()),
                    pa.array(spans, pa.string()), pa.array([len(added) for _, added in found], pa.int64()),
                ],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RESULT_SCHEMA)
