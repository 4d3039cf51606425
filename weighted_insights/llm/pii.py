"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns find emails, IP addresses, card numbers and phone numbers; what they find is final.  The
random field adds what they miss: numbers written in other ways, spelt-out addresses, secrets.  It
scores whole segments of up to five chunks (blank-separated, without marks around them) by what the
segment looks like and what stands before it, and a dynamic program over boundaries and types takes the
best reading of a line.  A segment that is personal data holds a digit, an ``@`` or a spelt-out ``dot``, so only the
neighbourhood of those is read.  The weights are learned from generated lines.  No pattern is tried at every place
of a long run, so a text takes time in proportion to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import Texts, map_texts, slices

KINDS = ("email", "ip", "card", "phone", "secret")
Span = tuple[int, int, str]

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match cannot begin inside a run of digits, as it would have begun at the run's start.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")

TRIGGERS = re.compile(r"[0-9@]|(?<![A-Za-z])dot(?![A-Za-z])", re.I)
TRIGGER = np.zeros(256, bool)
TRIGGER[list(b"0123456789@")] = True
DOT = re.compile(rb"(?<![A-Za-z])dot(?![A-Za-z])", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def emails(text: str) -> Iterable[tuple[int, int]]:
    """Leftmost matches, found from their ``@``, so that no long run of letters is tried at each of its places."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, by start and then by kind."""
    found = [(a, b, "email") for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = only_digits(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 10 <= len(only_digits(m.group())) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=order)


def order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


# The random field -------------------------------------------------------------------------------

LONGEST = 5
#: Chunks read on each side of one that holds a digit or an @.
AROUND = 4
LABELS = ("other", *KINDS)

CHUNK = re.compile(r"\S+")
EDGE_LEFT = " \t\"'`([{<*#%&$!|=:;,"
EDGE_RIGHT = " \t\"'`)]}>*#%&$!|=:;,.?"
HEX = re.compile(r"[0-9a-fA-F]{24,}")
KEYLIKE = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_+/=-]{20,}")
MAILLIKE = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+")
#: Words that stand before a thing, not for a host.
ARTICLES = frozenset("a an the this that each every".split())
BRACKETED = re.compile(r"[\[(] ?(at|dot) ?[\])]", re.I)
IPLIKE = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
PHONELIKE = re.compile(r"(?:(?:\+|00)[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}")
GROUPS = re.compile(r"[0-9]{4}(?:[ .-][0-9]{4}){3}|[0-9]{4}[ .-][0-9]{6}[ .-][0-9]{5}")
DATE = re.compile(r"[0-9]{1,4}[-/.:][0-9]{1,2}(?:[-/.:][0-9]{1,4})?")
NUMBER = re.compile(r"[0-9][0-9.,]*")

#: Words before a segment that hint at its kind.
HINTS = {
    "secret": frozenset("token key secret password passwd pwd apikey api_key auth bearer".split()),
    "phone": frozenset("tel phone call mobile fax telephone cell".split()),
    "card": frozenset("card visa mastercard amex cc creditcard".split()),
    "email": frozenset("mail email e-mail contact write".split()),
    "ip": frozenset("ip host server addr".split()),
    "count": frozenset("version section page chapter no number year v vol figure table order item cc-by by-nc by by-sa".split()),
}
SIZES = (0, 3, 6, 9, 12, 15, 16, 19)
FEATURES = 46


@dataclass(frozen=True)
class Chunk:
    """A blank-separated piece of a line, without the marks around it."""

    start: int
    end: int
    #: Whether an equals sign or colon ends it or stands alone.
    assigns: bool
    #: Whether it holds a digit or an @, or is or holds a spelt-out dot.
    trigger: bool
    digits: str
    letters: int


def chunks(text: str, start: int, end: int) -> list[Chunk]:
    out = []
    for m in CHUNK.finditer(text, start, end):
        raw = m.group()
        left = len(raw) - len(raw.lstrip(EDGE_LEFT))
        core = raw[left:].rstrip(EDGE_RIGHT) if left < len(raw) else ""
        a = m.start() + left
        # An opening bracket of an area code belongs to the number.
        if left and raw[left - 1] == "(" and core[:1].isdigit():
            a -= 1
        letters = len(core) if core.isalpha() else sum(map(str.isalpha, core))
        out.append(Chunk(a, m.start() + left + len(core), raw[-1] in "=:", TRIGGERS.search(core) is not None, only_digits(core), letters))
    return out


def spelt(segment: str) -> bool:
    """Whether the segment is an address with ``at`` or ``dot`` written out, in brackets or as words of their own."""
    names = BRACKETED.sub(r" \1 ", segment).split()
    if not 3 <= len(names) <= 2 * LONGEST:
        return False
    marks = [{"at": "@", "dot": "."}.get(name.lower(), name) for name in names]
    if any(m == "@" and after.lower() in ARTICLES for m, after in zip(marks, names[1:])):
        return False
    # Names and marks take turns: two names beside each other are no address.
    written = [mark in ("@", ".") for mark in marks]
    if not any(w and m != n for w, m, n in zip(written, marks, names)) or any(a == b for a, b in zip(written, written[1:])):
        return False
    return MAILLIKE.fullmatch("".join(marks)) is not None


def segment_features(text: str, line: list[Chunk], i: int, j: int) -> list[int]:
    """Numbers of the features of the segment of chunks ``i .. j``."""
    segment = text[line[i].start : line[j].end]
    digits = "".join([c.digits for c in line[i : j + 1]])
    letters = sum(c.letters for c in line[i : j + 1])
    n = len(digits)
    out = [next((k for k, size in enumerate(SIZES) if n <= size), len(SIZES))]
    out.append(9 + (0 if not letters else 1 if letters <= 3 else 2))
    out.append(12 + j - i)
    out.append(17 + min(segment.count("."), 4))
    shape = (
        "@" in segment,
        segment[:1] == "+" or segment[:2] == "00",
        "(" in segment,
        "-" in segment,
        HEX.fullmatch(segment),
        KEYLIKE.fullmatch(segment),
        MAILLIKE.fullmatch(segment),
        spelt(segment),
        IPLIKE.fullmatch(segment) and all(int(p) <= 255 for p in segment.split(".")),
        PHONELIKE.fullmatch(segment) and 9 <= n <= 15,
        GROUPS.fullmatch(segment),
        13 <= n <= 19 and not letters and luhn(digits),
        13 <= n <= 19 and not letters and not luhn(digits),
        DATE.fullmatch(segment),
        NUMBER.fullmatch(segment),
    )
    out += [22 + k for k, holds in enumerate(shape) if holds]
    before = [text[c.start : c.end].lower() for c in line[max(0, i - 2) : i]]
    for k, words in enumerate(HINTS.values()):
        if any(b in words for b in before):
            out.append(37 + k)
    if i and line[i - 1].assigns:
        out.append(43)
    if not any(c.trigger for c in (line[i], line[j])):
        out.append(44)
    out.append(45)
    return out


def segment_scores(text: str, line: list[Chunk], weights: np.ndarray) -> np.ndarray:
    """Score of every segment by end chunk, length - 1 and label; impossible ones are -inf."""
    scores = np.full((len(line), LONGEST, len(LABELS)), -np.inf)
    for j in range(len(line)):
        scores[j, 0, 0] = 0.0
        for length in range(1, min(LONGEST, j + 1) + 1):
            i = j - length + 1
            if line[i].start < line[j].end and any(c.trigger for c in line[i : j + 1]):
                found = weights[segment_features(text, line, i, j)].sum(0)
                scores[j, length - 1, 1:] = found[1:]
                if length == 1:
                    scores[j, 0, 0] = found[0]
    return scores


def best_reading(scores: np.ndarray, follow: np.ndarray) -> list[tuple[int, int, int]]:
    """Segments ``(first, last, label)`` of the reading with the highest score, without those that are ``other``."""
    n, longest, labels = scores.shape
    best, back = np.full((n + 1, labels), -np.inf), {}
    before = np.zeros((n + 1, labels))
    origin = np.zeros((n + 1, labels), np.int64)
    for j in range(n):
        most = min(longest, j + 1)
        options = before[j - np.arange(most)] + scores[j, :most]
        length = options.argmax(0)
        best[j + 1] = options[length, np.arange(labels)]
        back[j + 1] = length
        paths = best[j + 1][:, None] + follow
        origin[j + 1] = paths.argmax(0)
        before[j + 1] = paths.max(0)
    out, at, label = [], n, int(best[n].argmax()) if n else 0
    while at > 0:
        first = at - 1 - int(back[at][label])
        if label:
            out.append((first, at - 1, label))
        label, at = int(origin[first][label]), first
    return out[::-1]


# Learning ---------------------------------------------------------------------------------------

LINE = 14
TRAIN_LINES = 300


def _generated_line(random: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """A line of ``LINE`` chunks and its segments."""
    pick = lambda options: options[int(random.integers(len(options)))]
    digits = lambda n: "".join(map(str, random.integers(0, 10, n)))
    word = lambda: "".join(pick("bcdfglmnprst") + pick("aeiou") for _ in range(int(random.integers(1, 5))))

    def card() -> str:
        body = pick("3456") + digits(int(pick((13, 14, 14, 14))))
        whole = next(body + c for c in "0123456789" if luhn(body + c))
        mark = pick(("", "", " ", "-", "."))
        return mark.join(whole[k : k + 4] for k in range(0, len(whole), 4)) if len(whole) == 16 else whole

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return pick((f"+{pick('1234')} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{pick('3456')}{pick('0123')} {a} {b} {c}", f"00{pick('34')}{pick('12')} {a} {b} {c}"))

    def email() -> str:
        user, host, end = word() + pick((".", "_", "")) + word(), word(), pick(("com", "org", "example.com"))
        return pick((f"{user}@{host}.{end}", f"{user}.{digits(2)}@{host}{pick('0123456789')}.{end}", f"{user}{digits(2)} at {host} dot com", f"{user}{digits(2)} (at) {host} (dot) org", f"{user}@{host} dot com", f"{user} at {host} dot com", f"{user} (at) {host} (dot) {end[:3]}", f"{user}[at]{host}[dot]org"))

    def secret() -> str:
        return pick(("".join(pick("0123456789abcdef") for _ in range(pick((32, 40, 64)))), pick(("sk", "pk", "ghp")) + "_" + "".join(pick("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(30)) + "7"))

    makers = (None, email, lambda: ".".join(str(int(random.integers(0, 256))) for _ in range(4)), card, phone, secret)
    hints = (None, ("mail", "contact"), ("host", "ip"), ("card", "visa"), ("call", "tel"), ('token = "', "key: ", 'secret = "'))
    numbers = (
        lambda: str(int(random.integers(0, 3000))),
        lambda: f"Version {int(random.integers(1, 9))}.{int(random.integers(0, 9))}.",
        lambda: f"version {int(random.integers(1, 9))}.",
        lambda: f"{int(random.integers(1990, 2030))}-{int(random.integers(10, 13))}-{int(random.integers(10, 29))}",
        lambda: f"{int(random.integers(1, 13))}:{int(random.integers(10, 60))}",
        lambda: f"{int(random.integers(1, 999))},{digits(3)}",
        lambda: f"CC BY-NC {int(random.integers(1, 5))}.0.",
        lambda: f"section {int(random.integers(1, 9))}.{int(random.integers(1, 9))}.{int(random.integers(1, 9))}",
        lambda: f"{word()}{int(random.integers(1, 100))}",
        lambda: digits(int(pick((5, 6, 8)))),
        lambda: pick(("dot", f"the dot {word()}", f"at the dot of {word()}", f"at {word()} a dot", f"dot {word()} {word()}")),
        lambda: next(d for d in iter(lambda: digits(16), None) if not luhn(d)),
    )
    parts: list[tuple[str, int]] = []
    while sum(len(p.split()) for p, _ in parts) < LINE:
        draw = random.random()
        if draw < 0.62:
            parts.append((word() + pick(("", "", "", ",", ".")), 0))
        elif draw < 0.8:
            parts.append((pick(numbers)(), 0))
        else:
            label = int(random.integers(1, len(LABELS)))
            if random.random() < 0.5 or label == LABELS.index("secret"):
                parts.append((pick(hints[label]), 0))
            parts.append((makers[label](), label))
    text, marked = "", []
    for part, label in parts:
        if text and not text.endswith('"'):
            text += " "
        marked.append((len(text), len(text) + len(part), label))
        text += part
    line = chunks(text, 0, len(text))[:LINE]
    out = []
    for a, b, label in marked:
        inside = [k for k, c in enumerate(line) if c.start >= a and c.end <= b]
        if label and inside and inside[-1] - inside[0] < LONGEST and b <= line[-1].end + 1:
            out.append((inside[0], inside[-1], label))
    return text[: line[-1].end], out


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(values - top).sum(axis)) + np.squeeze(top, axis)


def expectations(scores: np.ndarray, follow: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line: probability of every segment, expected label pairs, and log partition sum.

    ``scores`` is lines x chunks x lengths x labels, all lines of one length; segment-level forward-backward.
    """
    lines, n, longest, labels = scores.shape
    ahead = np.full((lines, n + 1, labels), -np.inf)
    enter = np.zeros((lines, n + 1, labels))
    for j in range(n):
        most = min(longest, j + 1)
        ahead[:, j + 1] = _log_sum(np.stack([enter[:, j - k] + scores[:, j, k] for k in range(most)], 1), 1)
        enter[:, j + 1] = _log_sum(ahead[:, j + 1, :, None] + follow, 1)
    total = _log_sum(ahead[:, n], 1)
    back = np.zeros((lines, n + 1, labels))
    begin = np.full((lines, n + 1, labels), -np.inf)
    for t in range(n - 1, -1, -1):
        most = min(longest, n - t)
        begin[:, t] = _log_sum(np.stack([scores[:, t + k, k] + back[:, t + k + 1] for k in range(most)], 1), 1)
        back[:, t] = _log_sum(follow[None] + begin[:, t, None, :], 2)
    chance = np.zeros_like(scores)
    for j in range(n):
        for k in range(min(longest, j + 1)):
            chance[:, j, k] = np.exp(enter[:, j - k] + scores[:, j, k] + back[:, j + 1] - total[:, None])
    pairs = np.exp(ahead[:, 1:n, :, None] + follow + begin[:, 1:n, None, :] - total[:, None, None, None]).sum((0, 1))
    return chance, pairs, total


@dataclass(frozen=True)
class Model:
    """Weights by feature and label, and by pair of neighbouring labels."""

    weights: np.ndarray
    follow: np.ndarray


@lru_cache(maxsize=2)
def train(lines: int = TRAIN_LINES, seed: int = 11, steps: int = 90, rate: float = 0.2, penalty: float = 2e-4) -> Model:
    """Maximum conditional likelihood on generated lines; the same in every process."""
    random = np.random.Generator(np.random.PCG64(seed))
    samples = []
    while len(samples) < lines:
        text, segments = _generated_line(random)
        line = chunks(text, 0, len(text))
        if len(line) == LINE and all(any(c.trigger for c in line[i : j + 1]) for i, j, _ in segments):
            samples.append((text, line, segments))
    labels, b = len(LABELS), len(samples)
    features = np.zeros((b, LINE, LONGEST, FEATURES), np.float32)
    possible = np.zeros((b, LINE, LONGEST, labels), bool)
    seen_pairs, wanted = np.zeros((labels, labels)), np.zeros((b, LINE, LONGEST, labels), np.float32)
    for s, (text, line, segments) in enumerate(samples):
        for j in range(LINE):
            possible[s, j, 0, 0] = True
            for length in range(1, min(LONGEST, j + 1) + 1):
                i = j - length + 1
                if any(c.trigger for c in line[i : j + 1]):
                    possible[s, j, length - 1, 1:] = True
                    features[s, j, length - 1, segment_features(text, line, i, j)] = 1
        covered = {k: (i, j, label) for i, j, label in segments for k in range(i, j + 1)}
        reading, k = [], 0
        while k < LINE:
            i, j, label = covered.get(k, (k, k, 0))
            reading.append((i, j, label))
            wanted[s, j, j - i, label] = 1
            k = j + 1
        for (_, _, x), (_, _, y) in zip(reading, reading[1:]):
            seen_pairs[x, y] += 1
    flat = features.reshape(-1, FEATURES)
    used = np.flatnonzero(flat.any(1))
    weights, follow = np.zeros((FEATURES, labels)), np.zeros((labels, labels))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(follow), np.zeros_like(follow)]
    for step in range(1, steps + 1):
        scores = np.zeros((flat.shape[0], labels))
        scores[used] = flat[used] @ weights
        scores = np.where(possible, scores.reshape(possible.shape), -np.inf)
        chance, pairs, _ = expectations(scores, follow)
        gap = (wanted - chance).reshape(-1, labels)
        slopes = [flat[used].T @ gap[used] / b - penalty * weights, (seen_pairs - pairs) / b - penalty * follow]
        for k, (target, slope) in enumerate(zip((weights, follow), slopes)):
            first, second = moments[2 * k], moments[2 * k + 1]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            target += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(weights, follow)


# Applying ---------------------------------------------------------------------------------------


def windows(text: str) -> Iterable[list[Chunk]]:
    """Neighbourhoods of triggers inside a line, those that touch taken together."""
    start = 0
    while start <= len(text):
        end = text.find("\n", start)
        end = len(text) if end < 0 else end
        trigger = TRIGGERS.search(text, start, end)
        if trigger:
            line = chunks(text, start, end)
            hits = [k for k, c in enumerate(line) if c.trigger]
            low = high = None
            for k in hits:
                if high is not None and k - AROUND <= high:
                    high = min(len(line), k + AROUND + 1)
                    continue
                if high is not None:
                    yield line[low:high]
                low, high = max(0, k - AROUND), min(len(line), k + AROUND + 1)
            if high is not None:
                yield line[low:high]
        start = end + 1


def added_spans(text: str, model: Model, base: list[Span]) -> list[Span]:
    """What the random field finds beside the base spans."""
    taken = sorted((a, b) for a, b, _ in base)
    out = []
    for line in windows(text):
        for i, j, label in best_reading(segment_scores(text, line, model.weights), model.follow):
            a, b = line[i].start, line[j].end
            if not any(x < b and a < y for x, y in taken):
                out.append((a, b, LABELS[label]))
    return out


def find_spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    return base, sorted(base + added_spans(text, model, base), key=order)


def has_trigger(texts: list[bytes]) -> np.ndarray:
    """Whether a text can hold a span: all others need not be read."""
    read = Texts(texts)
    return (read.per_text(TRIGGER[read.data]) > 0) | np.fromiter((DOT.search(t) is not None for t in texts), bool, len(texts))


SCHEMA = "doc_id long, base array<struct<start:int,end:int,kind:string>>, spans array<struct<start:int,end:int,kind:string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``spans`` (start, end, kind; code points, end exclusive).

    ``spans`` holds the base spans and those added.  A null or empty text has none.  Repeated rows are read each on their
    own; a null ``doc_id`` stays null; an empty table gives no row; other columns are not read.
    """
    model = train()

    def run(batches):
        for batch, texts in slices(batches):
            base, spans = [], []
            for text, wanted in zip(texts, has_trigger(texts)):
                found = find_spans(text.decode("utf-8", "replace"), model) if wanted else ([], [])
                for column, rows in zip((base, spans), found):
                    column.append([{"start": a, "end": b, "kind": k} for a, b, k in rows])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(base, _SPANS), pa.array(spans, _SPANS)], ["doc_id", "base", "spans"]
            )

    return map_texts(docs, run, SCHEMA)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets, overlapping spans by that of the first.

    Other columns stay as they are, but ``n_chars``, if there is one, follows the new text.
    """
    model = train()

    def run(batches):
        for batch, texts in slices(batches):
            column = batch.column("text").to_pylist()
            for i, (text, wanted) in enumerate(zip(texts, has_trigger(texts))):
                if wanted:
                    column[i] = redacted(column[i], find_spans(column[i], model)[1])
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(column, pa.string()))

    out = map_texts(docs, run, docs.schema, tuple(docs.columns))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def redacted(text: str, spans: list[Span]) -> str:
    parts, done = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start < done:
            # Overlapping spans go together.
            done = max(done, end)
            continue
        parts += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join(parts) + text[done:]


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    counts = [count_of("base", kind) for kind in ("email", "ip", "card", "phone")]
    digest = F.sha2(joined(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, joined(F.col("spans")).alias("spans"), count_of("spans", "secret"))
