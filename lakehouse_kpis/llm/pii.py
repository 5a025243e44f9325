"""Personal data: rule-based spans, and a character-level BiLSTM-CRF that adds spans to them.

The network is trained from spans that the rules label in a bounded sample of windows: as they are,
and written anew in ways the rules do not allow (spelled-out marks, bracketed dots, other separators,
no country code, one card after another), with words of those spellings put between other words as
examples of what is no span. Texts are read in overlapping windows, each window is decoded on its own,
and the spans of all windows of a text are reconciled in one pass: parts of a span that windows cut
are joined, and the set of spans without overlap that has the highest total score stays.

Every window of every text goes through the network; which texts hold marks or digits plays no part.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakehouse_kpis.llm import lstm_crf
from lakehouse_kpis.llm.tables import text_batches

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 80, 40   # a span of up to 40 characters is whole in some window, others are joined
REWRITTEN = 1152          # windows with spans written anew that it is trained on besides
SAMPLE_WINDOWS = 768      # windows that the network is trained on
HIDDEN, EPOCHS, TRAIN_BATCH = 12, 12, 32
SURE = 0.8                # least mean probability of an added span
DECODE_BATCH = 4096       # windows that are decoded together

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# a run of digits is taken whole, with three more after points if there are: a match that begins inside
# of one could not end differently
_IP = re.compile(r"[0-9]++(?:(?:\.[0-9]++){3})?+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DOT = "(?<![A-Za-z])[Dd][Oo][Tt](?![A-Za-z])"
_MARK, _DOT_WORD = re.compile("[0-9@]"), re.compile(_DOT)

Span = tuple[int, int, int]  # start, end, index of the kind


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def rule_spans(text: str) -> list[Span]:
    """Spans that the rules find, by start and then kind; code points, end exclusive."""
    found = _emails(text)
    for m in _IP.finditer(text):
        if "." not in m[0]:
            continue
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from each at-sign outwards, in time linear in the text."""
    found, past, at = [], 0, text.find("@")
    while at >= 0:
        before = text[past:at]
        start = past + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end(), 0))
        past = domain.end() if domain else at + 1
        at = text.find("@", past)
    return found


def _tags(spans: list[Span], start: int, size: int) -> np.ndarray:
    """Tags of a window: 0 outside, 1 + 2 kind where a span begins, 2 + 2 kind inside."""
    tags = np.zeros(size, np.int64)
    for a, b, kind in spans:
        lo, hi = max(a - start, 0), min(b - start, size)
        if lo < hi and not tags[lo:hi].any():
            tags[lo:hi] = 2 + 2 * kind
            if a >= start:
                tags[lo] = 1 + 2 * kind
    return tags


def _window(codes: np.ndarray, start: int) -> np.ndarray:
    part = codes[start:start + WINDOW]
    if len(part) == WINDOW:
        return part
    return np.concatenate([part, np.full(WINDOW - len(part), lstm_crf.PAD)])


def _decoded(text: bytes | None) -> str:
    return (text or b"").decode("utf-8", "replace")


class _Least:
    """The `size` smallest distinct numbers of those seen; a larger one cannot be among the smallest of
    more numbers either."""

    def __init__(self, size: int):
        self.size = size
        self.heap: list[int] = []  # negated, so the largest comes first
        self.held: set[int] = set()

    def admits(self, number: int) -> bool:
        """Whether the number is among the smallest so far, itself seen."""
        if number in self.held:
            return True
        if len(self.heap) < self.size:
            heapq.heappush(self.heap, -number)
        elif self.heap and number < -self.heap[0]:
            self.held.discard(-heapq.heapreplace(self.heap, -number))
        else:
            return False
        self.held.add(number)
        return True


def sample(documents: DataFrame, rows: int = SAMPLE_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of up to `rows` windows round digits and at-signs, with the rules' labels.

    Windows with spans and windows without are taken in equal numbers, those with the smallest
    hashes of their contents among all windows of all texts, so the order of rows does not matter.
    """
    half = rows // 2

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least = {True: _Least(half), False: _Least(half)}
        for batch in batches:
            out = []
            for raw in batch["text"]:
                text = _decoded(raw)
                anchors = {m.start() // STRIDE for m in _MARK.finditer(text)}
                if "dot" in text.lower():
                    anchors.update(m.start() // STRIDE for m in _DOT_WORD.finditer(text))
                spans = rule_spans(text) if anchors else []
                codes = None
                for cell in sorted(anchors):
                    start = max(cell * STRIDE - STRIDE // 2, 0)
                    part = text[start:start + WINDOW]
                    digest = hashlib.blake2b(part.encode("utf-8", "replace"), digest_size=8)
                    h = int.from_bytes(digest.digest(), "big") >> 1
                    has = any(a < start + WINDOW and b > start for a, b, _ in spans)
                    if not least[has].admits(h):
                        continue
                    codes = lstm_crf.symbols(text) if codes is None else codes
                    tags = _tags(spans, start, WINDOW)
                    out.append((
                        has, h, _window(codes, start).astype(np.int8).tobytes(),
                        tags.astype(np.int8).tobytes(),
                    ))
            yield pd.DataFrame(out, columns=["has", "h", "x", "y"])

    found = documents.select(F.col("text").cast("binary").alias("text")).mapInPandas(
        windows, "has boolean, h bigint, x binary, y binary"
    )
    # copies of a passage give the same window, which is learnt from once
    found = found.groupBy("has", "h").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    # both kinds in one pass over the texts; each task keeps its smallest hashes before they are shuffled
    place = F.row_number().over(Window.partitionBy("has").orderBy("h"))
    found = found.withColumn("place", place).where(F.col("place") <= rows // 2)
    taken = found.orderBy(F.desc("has"), "h").collect()

    def matrix(column: str) -> np.ndarray:
        flat = np.frombuffer(b"".join(bytes(r[column]) for r in taken), np.int8)
        return flat.reshape(-1, WINDOW).astype(np.int64)

    return matrix("x"), matrix("y")


def fit(documents: DataFrame, rows: int = SAMPLE_WINDOWS) -> lstm_crf.Network | None:
    """The network, trained on the sample and its rewritten windows; None if the rules find nothing."""
    x, y = sample(documents, rows)
    if not y.any():
        return None
    return trained(x, y)


def trained(x: np.ndarray, y: np.ndarray, seed: int = 11) -> lstm_crf.Network:
    """The network for a sample of any size: a small one is rewritten more often, each time anew."""
    rng = np.random.default_rng(seed)
    turns = [i for i, tags in enumerate(y) for _ in range(2 if tags.any() else 1)]
    more = [rewritten(x[i], y[i], rng) for i, _ in zip(itertools.cycle(turns), range(REWRITTEN))]
    x = np.concatenate([x, np.array([a for a, _ in more])])
    y = np.concatenate([y, np.array([b for _, b in more])])
    return lstm_crf.train(x, y, 1 + 2 * len(KINDS), HIDDEN, EPOCHS, TRAIN_BATCH)


AT = (" at ", " (at) ", "[at]", " @ ", " AT ", "(at)", " [at] ")
DOT = (" dot ", "(dot)", "[dot]", " DOT ", " [dot] ", ".", " . ")
IP_DOT = ("[.]", " . ", "(.)", " dot ", "[dot]")


def spelled(part: str, kind: int, rng: np.random.Generator) -> list[tuple[str, bool]]:
    """A span written in a way that the rules do not allow: pieces, and whether each is a span."""
    def one(choices: tuple[str, ...]) -> str:
        return choices[rng.integers(len(choices))]

    if kind == 0 and "@" in part:
        local, domain = part.split("@", 1)
        at = one(AT)
        return [(local + at + domain.replace(".", one(DOT if at != " @ " else (".",))), True)]
    if kind == 1:
        return [(part.replace(".", one(IP_DOT)), True)]
    digits = _NOT_DIGIT.sub("", part)
    if kind == 2:
        if rng.random() < 0.3:  # two cards in a row, of which the rules make one long number
            return [(digits, True), (one((" ", "-")), False), (digits, True)]
        mark = one((".", "/", "_", "  ", " - ", " / ", " . "))
        return [(mark.join(digits[i:i + 4] for i in range(0, len(digits), 4)), True)]
    mark, tail = one(("-", ".", " ", "/", " - ")), digits[-10:]
    inner = [tail[:3], tail[3:6], tail[6:]]
    if rng.random() < 0.3:
        inner[0] = f"({inner[0]})"
    return [(one(("", "", "0", "00" + digits[:-10] + mark)) + mark.join(inner), True)]


def rewritten(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of a window with its whole spans written anew, and words of the spellings put
    between some of its other words, where they are no spans."""
    text = "".join(chr(s + 32) if s < lstm_crf.WHITE else "\0" for s in x)
    out_x: list[int] = []
    out_y: list[int] = []

    def put(piece: str, kind: int | None) -> None:
        out_x.extend(lstm_crf.symbols(piece).tolist())
        inside = 0 if kind is None else 2 + 2 * kind
        out_y.extend([inside] * len(piece))
        if kind is not None:
            out_y[len(out_y) - len(piece)] = inside - 1

    t = 0
    while t < WINDOW:
        end, kind = t + 1, (int(y[t]) - 1) // 2
        if y[t] % 2 == 1:
            while end < WINDOW and y[end] == 2 + 2 * kind:
                end += 1
            if end < WINDOW:
                for piece, inside in spelled(text[t:end], kind, rng):
                    put(piece, kind if inside else None)
                t = end
                continue
        if y[t] == 0 and text[t] == " " and rng.random() < 0.06:
            put((" at ", " dot ", " AT ", " [.] ", " (at) ")[rng.integers(5)], None)
        else:
            out_x += x[t:end].tolist()
            out_y += y[t:end].tolist()
        t = end
    if not y.any() and rng.random() < 0.3:  # a number that is none of the kinds
        cut = int(rng.integers(WINDOW // 2))
        made = " " + str(rng.integers(10 ** rng.integers(1, 13))) + ("." + str(rng.integers(99))) * int(
            rng.integers(3)) + " "
        out_x[cut:cut] = lstm_crf.symbols(made).tolist()
        out_y[cut:cut] = [0] * len(made)
    lack = max(WINDOW - len(out_x), 0)
    return (np.array((out_x + [lstm_crf.PAD] * lack)[:WINDOW]), np.array((out_y + [0] * lack)[:WINDOW]))


def _all_windows(codes: np.ndarray) -> np.ndarray:
    """The windows of a text that begin at 0, STRIDE, ..., one a row: each character is in some."""
    ends = -len(codes) % STRIDE + WINDOW - STRIDE
    padded = np.concatenate([codes, np.full(ends, lstm_crf.PAD)])
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def model_spans(net: lstm_crf.Network, texts: list[str]) -> list[list[tuple]]:
    """For each text the candidate spans of its windows: (start, end, kind, score). All windows of the
    whole text are decoded. Spans that windows cut are put together from their parts."""
    found: list[list[tuple]] = [[] for _ in texts]
    cut: list[list[tuple]] = [[] for _ in texts]
    held: list[np.ndarray] = []
    cells: list[tuple[int, int]] = []

    def read() -> None:
        for row, tags, sure in zip(*lstm_crf.tagged(net, np.concatenate(held))):
            n, start = cells[row]
            for *span, left, right in _spans_of(tags, sure, start, len(texts[n])):
                if left or right:
                    cut[n].append((*span, left, right))
                else:
                    found[n].append(tuple(span))
        held.clear()
        cells.clear()

    for n, text in enumerate(texts):
        windows = _all_windows(lstm_crf.symbols(text)) if text else []
        at = 0
        while at < len(windows):
            part = windows[at:at + DECODE_BATCH - len(cells)]
            held.append(part)
            cells += [(n, (at + i) * STRIDE) for i in range(len(part))]
            at += len(part)
            if len(cells) == DECODE_BATCH:
                read()
    if cells:
        read()
    for n, parts in enumerate(cut):
        found[n] += _joined(parts)
    return found


def _joined(parts: list[tuple]) -> list[tuple]:
    """Spans put together from parts (start, end, kind, score, cut on the left, cut on the right): of
    one kind, each overlapping or touching the next, whole at both ends."""
    out = []
    for kind in {p[2] for p in parts}:
        own = sorted(p for p in parts if p[2] == kind)
        # the part that begins a span, then whichever parts go on from it, in order of their windows
        for i, (a, end, _, score, left, _) in enumerate(own):
            if left:
                continue
            weight, total, next_one = end - a, score * (end - a), i + 1
            while next_one < len(own) and own[next_one][0] <= end:
                b, stop, _, more, goes_on, cut = own[next_one]
                next_one += 1
                if not goes_on or stop < end:
                    continue
                total, weight, end = total + more * (stop - b), weight + stop - b, stop
                if not cut:
                    out.append((a, end, kind, total / weight))
                    break
    return out


def _spans_of(tags: np.ndarray, sure: np.ndarray, start: int, size: int) -> list[tuple]:
    """Spans of one decoded window, and whether the window cuts them on the left and on the right."""
    out, t = [], 0
    while t < WINDOW:
        if tags[t] == 0:
            t += 1
            continue
        kind, end = (int(tags[t]) - 1) // 2, t + 1
        while end < WINDOW and tags[end] == 2 + 2 * kind:
            end += 1
        left, right = t == 0 and start > 0, end == WINDOW and start + WINDOW < size
        if start + end <= size:
            out.append((start + t, start + end, kind, float(sure[t:end].mean()), left, right))
        t = end
    return out


_POINT = r"(?:\s?[\[(]?\s?\.\s?[\])]?\s?|\s?[\[(]\s?dot\s?[\])]\s?|\s+dot\s+)"
_LIKE = (
    re.compile(
        r"[A-Za-z0-9._%+-]+(?:\s?[\[(]?\s?@\s?[\])]?\s?|\s?[\[(]\s?at\s?[\])]\s?|\s+at\s+)"
        rf"[A-Za-z0-9-]+(?:{_POINT}[A-Za-z0-9-]+)+", re.IGNORECASE
    ),
    re.compile(rf"[0-9]{{1,3}}(?:{_POINT}[0-9]{{1,3}}){{3}}", re.IGNORECASE),
    re.compile(r"[0-9](?:[ ./_-]{0,3}[0-9])+"),
    re.compile(r"[+(]*[0-9]+(?:[ ()./-]{1,3}[0-9]+){2,}"),
)


def _plausible(text: str, a: int, b: int, kind: int) -> bool:
    """Whether an added span can be of its kind at all: whole tokens, the right marks and digits."""
    part = text[a:b]
    if (a and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum()):
        return False
    if not _LIKE[kind].fullmatch(part):
        return False
    digits = _NOT_DIGIT.sub("", part)
    if kind == 1:
        return all(int(p) <= 255 for p in _NOT_DIGIT.split(part))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind != 3 or 10 <= len(digits) <= 15


def reconcile(text: str, base: list[Span], candidates: list[tuple]) -> list[Span]:
    """Base spans, all of them, and the added ones: candidates that are sure and plausible and touch
    no base span, chosen without overlap for the highest total of score times length."""
    taken = sorted((a, b) for a, b, _ in base)
    reach = list(np.maximum.accumulate([b for _, b in taken])) if taken else []
    starts = [a for a, _ in taken]
    best: dict[Span, float] = {}
    for a, b, kind, score in candidates:
        before = bisect_right(starts, b - 1)
        if score < SURE or (before and reach[before - 1] > a) or not _plausible(text, a, b, kind):
            continue
        best[a, b, kind] = max(score, best.get((a, b, kind), 0.0))
    order = sorted(best, key=lambda s: (s[1], s[0], s[2]))
    ends, total, choice = [s[1] for s in order], [0.0], []
    for i, s in enumerate(order):
        j = bisect_right(ends, s[0], 0, i)
        gain = total[j] + best[s] * (s[1] - s[0])
        choice.append((gain > total[i], j))
        total.append(max(gain, total[i]))
    added, i = [], len(order)
    while i:
        take, j = choice[i - 1]
        if take:
            added.append(order[i - 1])
        i = j if take else i - 1
    return sorted([*base, *added], key=lambda s: (s[0], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def find(texts: list[str], net: lstm_crf.Network | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [rule_spans(t) for t in texts]
    more = model_spans(net, texts) if net else [[] for _ in texts]
    return [(b, reconcile(t, b, m) if m else b) for t, b, m in zip(texts, base, more)]


def personal_data(documents: DataFrame, net: lstm_crf.Network | None) -> DataFrame:
    """doc_id, counts of the base spans by kind, base_sha256, spans and n_added for each row.

    A null text is an empty one; it and a text without personal data have counts of 0, the digest of
    the empty string and empty spans. Repeated rows and null ids are rows like any other; other
    columns are not looked at; an empty table gives an empty result.
    """
    text_batches(documents.sparkSession)
    schema = ", ".join(f"n_{k} bigint" for k in KINDS)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for base, spans in find([_decoded(t) for t in batch["text"]], net):
                counts = [sum(k == kind for _, _, k in base) for kind in range(len(KINDS))]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                out.append((*counts, digest, written(spans), len(spans) - len(base)))
            names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
            made = pd.DataFrame(out, columns=names)
            made.insert(0, "doc_id", batch["doc_id"].array)
            yield made

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInPandas(
        rows, f"doc_id {id_type}, {schema}, base_sha256 string, spans string, n_added bigint"
    )


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets, overlapping ones as one."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(documents: DataFrame, net: lstm_crf.Network | None) -> DataFrame:
    """The rows of `documents` with personal data masked in the text, and n_chars, where there is
    such a column, to match. Texts without personal data, null ones too, are left as they are."""
    text_batches(documents.sparkSession)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = [_decoded(t) for t in batch]
            yield pd.Series([
                masked(t, s) if s else None for t, (_, s) in zip(texts, find(texts, net))
            ], dtype=object)

    made = documents.withColumn("text", F.coalesce(clean(F.col("text").cast("binary")), F.col("text")))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        made = made.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))
    return made.select(documents.columns)
