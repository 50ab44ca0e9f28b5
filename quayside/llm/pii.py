"""Personal data by a semi-Markov conditional random field.

Spans of the base patterns always stand. Around numbers, at-signs and spelled-out
addresses the field scores whole candidate segments (features of the span as a whole:
digit counts, grouping, checksum, octets, written-out signs, words before it) and bounded
dynamic programming chooses boundaries and kinds jointly. Its weights are fitted here, by
likelihood, on generated sentences; a fit is the same every time.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import ship

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Where the field looks: words with digits or at-signs, and addresses spelled out. Every
#: pattern reads a character a bounded number of times, however long its word.
MARKED = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20[^\s0-9@]*+[0-9@]\S*+)*+")
AT_WORD = re.compile(r"(?<=[\x20\[(])(?:at|AT)(?=[\x20\])])")
AT_HOST = re.compile(r"[\x20\])]{1,3}+[A-Za-z0-9-]++[\x20\[(]{1,3}+(?:dot|DOT)[\x20\])]{1,3}+[A-Za-z]{2,8}+(?:\x20(?:dot|DOT)\x20[A-Za-z]{2,8})?")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\sA-Za-z0-9]|\s+")
LONGEST, LONGEST_CHARS = 24, 320  # tokens and characters of a segment, at most
PIECE_TOKENS = 400  # an island's segments are scored in such pieces, and decoded as a whole
HINTS = {
    "email": {"email", "mail", "e", "contact", "write", "reach"},
    "ip": {"ip", "host", "server", "address", "addr", "from"},
    "card": {"card", "visa", "credit", "mastercard", "payment", "cc"},
    "phone": {"phone", "call", "tel", "telephone", "mobile", "fax", "cell"},
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _local_start(text: str, at: int, least: int) -> int:
    """Where the run of local-part characters that ends before ``at`` begins."""
    while at > least and text[at - 1] in LOCAL_CHARS:
        at -= 1
    return at


def _octets(quad: str) -> bool:
    return all(len(p := part.lstrip("0")) < 4 and int(p or "0") <= 255 for part in quad.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the four base patterns, leftmost and non-overlapping each;
    matches that fail their test are dropped. In time linear in the text: an address is
    read outwards from its sign, and dotted numbers from where a number begins."""
    out, least = [], 0
    at = text.find("@")
    while at >= 0:
        lo = _local_start(text, at, least)
        if lo < at and (m := DOMAIN.match(text, at + 1)):
            out.append((lo, 0, m.end()))
            least = m.end()
        else:
            least = at + 1  # no local part holds the sign
        at = text.find("@", least)
    out += [(m.start(), 1, m.end()) for m in QUAD.finditer(text) if _octets(m[0])]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    at = text.find("+")
    while at >= 0:  # no match holds a second plus sign
        if m := PHONE.match(text, at):
            if 10 <= sum(map(m[0].count, "0123456789")) <= 15:
                out.append((at, 3, m.end()))
        at = text.find("+", at + 1)
    return sorted(out)


NAMES = (
    "one", "d<7", "d7-9", "d10-11", "d12-13", "d14-19", "d>19", "luhn", "octets", "dots3", "at", "at_word", "dot_word", "name_at_domain", "plus", "parens",
    "dash_space", "dots", "groups4", "groups334", "solid", "letters", "commas_slashes", "clean_ends", "hint_email", "hint_ip", "hint_card", "hint_phone", "hint_none", "other",
)


def features(span: str, before: str) -> np.ndarray:
    """0/1 features of a whole candidate span and the words before it."""
    digits = "".join(c for c in span if c in "0123456789")
    groups = re.findall("[0-9]+", span)
    sizes = [len(g) for g in groups]
    letters = sum(c.isalpha() for c in span)
    n, low = len(digits), span.lower()
    at_word, dot_word = bool(re.search(r"(?<![a-z])at(?![a-z])", low)), bool(re.search(r"(?<![a-z])dot(?![a-z])", low))
    hints = set(re.findall("[a-z]+", before.lower()))
    found = [bool(hints & HINTS[k]) for k in KINDS]
    at_like = "@" in span or at_word
    rest = re.sub(r"[0-9\x20().+-]", "", span)
    domain = bool(re.fullmatch(r"[a-z0-9._%+-]+[\x20\[(]*(?:@|at)[\x20\])]*[a-z0-9-]+(?:[\x20\[(]*(?:\.|dot)[\x20\])]*[a-z]{2,8})+", low))
    ends = span[-1].isalnum() and (span[0].isalnum() or span[0] in "+(")
    return np.array(
        [
            1, n < 7, 7 <= n <= 9, 10 <= n <= 11, 12 <= n <= 13, 14 <= n <= 19, n > 19,
            14 <= n <= 19 and luhn(digits), len(groups) == 4 and all(s <= 3 and int(g) <= 255 for s, g in zip(sizes, groups)), bool(re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", span)),
            "@" in span, at_word, dot_word, domain, span[0] == "+", span.count("(") == span.count(")") == 1,
            bool(re.fullmatch(r"[0-9\x20-]+", span)), "." in span and not at_like, sizes in ([4, 4, 4, 4], [4, 6, 5]), sizes[-3:] == [3, 3, 4] and len(sizes) <= 4, len(groups) == 1, letters > 0 and not at_like,
            any(c in ",/:;_=$%&*#|!" for c in span), ends, *found, not any(found), bool(rest) and not at_like,
        ],
        np.float64,
    )


def token_bounds(text: str, start: int, end: int) -> list[int]:
    return [start, *(m.end() for m in TOKEN.finditer(text, start, end))]


def segments(text: str, bounds: list[int], lo: int, hi: int) -> Iterator[tuple[int, int, str]]:
    """Segments (first, behind last token, span) that begin at tokens lo to hi: at most
    LONGEST tokens and LONGEST_CHARS characters, from and to a place where no letter or
    digit goes on, with a digit or a sign of an address inside."""
    for i in range(lo, min(hi, len(bounds) - 1)):
        a = bounds[i]
        if (a and text[a - 1].isalnum()) or not (text[a].isalnum() or text[a] in "+("):
            continue
        for j in range(i + 1, min(len(bounds) - 1, i + LONGEST) + 1):
            b = bounds[j]
            if b - a > LONGEST_CHARS:
                break
            if not text[b - 1].isalnum() or (b < len(text) and text[b].isalnum()):
                continue
            span = text[a:b]
            digits = sum(map(span.count, "0123456789"))
            if "\n" in span or digits > 24:
                break
            signs = "@" in span or re.search(r"(?i)(?<![a-z])at(?![a-z]).*(?<![a-z])dot(?![a-z])", span)
            if not signs and ("+" in span[1:] or any(c.isalpha() for c in span)):
                continue  # numbers of any kind hold no letters, and a plus sign only in front
            if signs or digits >= 7 or (digits >= 4 and span.count(".") == 3):
                yield i, j, span


def candidates(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int, str]]]:
    """Token bounds of an island and all its segments."""
    bounds = token_bounds(text, start, end)
    return bounds, list(segments(text, bounds, 0, len(bounds)))


def islands(text: str) -> list[tuple[int, int]]:
    """(start, end) of where the field looks, in order and apart."""
    found = [m.span() for m in MARKED.finditer(text)]
    least = 0
    for m in AT_WORD.finditer(text):
        if tail := AT_HOST.match(text, m.end()):
            lo = m.start()
            while m.start() - lo < 3 and lo > least and text[lo - 1] in "\x20[(":
                lo -= 1
            if (start := _local_start(text, lo, least)) < lo:
                found.append((start, tail.end()))
        least = m.end()
    out = []
    for start, end in sorted(found):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


class Field:
    """Weights per kind; a token outside all segments scores 0."""

    def __init__(self) -> None:
        self.w = np.zeros((len(KINDS), len(NAMES)))

    def scores(self, f: np.ndarray) -> np.ndarray:
        return f @ self.w.T

    def decode(self, n: int, scored: Iterator[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
        """Best segmentation of n tokens, (first, behind last, kind), of segments with
        their best kind and score, by first token."""
        best, came, done = np.full(n + 1, -np.inf), [None] * (n + 1), 0
        best[0] = 0.0

        def settle(i: int) -> None:  # no more segments end at i or before
            nonlocal done
            while done < i:
                done += 1
                if best[done - 1] >= best[done]:
                    best[done], came[done] = best[done - 1], None

        for i, j, kind, score in scored:
            settle(i)
            if (s := best[i] + score) > best[j]:
                best[j], came[j] = s, (i, kind)
        settle(n)
        out, j = [], n
        while j:
            if came[j] is None:
                j -= 1
            else:
                i, kind = came[j]
                out.append((i, j, kind))
                j = i
        return out[::-1]

    def gradient(self, n: int, segments: list[tuple[int, int]], f: np.ndarray, gold: set) -> np.ndarray:
        """Of the log-likelihood of the gold (first, behind last, kind) segments."""
        scores = self.scores(f)
        total = np.logaddexp.reduce(scores, axis=1)
        fwd, bwd = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            fwd[j] = np.logaddexp.reduce([fwd[j - 1], *(fwd[i] + total[k] for k, (i, e) in enumerate(segments) if e == j)])
        for i in range(n - 1, -1, -1):
            bwd[i] = np.logaddexp.reduce([bwd[i + 1], *(bwd[j] + total[k] for k, (s, j) in enumerate(segments) if s == i)])
        out = np.zeros_like(self.w)
        for k, (i, j) in enumerate(segments):
            p = np.exp(fwd[i] + bwd[j] + scores[k] - fwd[n])
            truth = np.array([(i, j, kind) in gold for kind in range(len(KINDS))], float)
            out += np.outer(truth - p, f[k])
        return out


def _sentence(rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A generated line with its true spans; half the lines hold look-alikes only."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghinorst") for _ in range(rng.randint(3, 8)))
    filler = lambda: " ".join(word() for _ in range(rng.randint(2, 5)))

    def card() -> str:
        body = rng.choice("456") + digits(14)
        full = next(body + c for c in "0123456789" if luhn(body + c))
        return rng.choice((full, *(s.join(full[k : k + 4] for k in range(0, 16, 4)) for s in " -._")))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice((f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+44 {digits(4)} {digits(6)}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}"))

    def email() -> str:
        name, host, end = word() + rng.choice(("", ".", "_")) + word(), word(), rng.choice(("com", "org", "net", "co"))
        return rng.choice((f"{name}@{host}.{end}", f"{name} at {host} dot {end}", f"{name} (at) {host} (dot) {end}", f"{name}[at]{host}[dot]{end}"))

    def ip() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    def other() -> str:
        a = digits(16)
        if luhn(a):
            a = a[:-1] + str((int(a[-1]) + 1) % 10)
        return rng.choice((
            a, digits(rng.randint(7, 13)), digits(rng.randint(20, 24)), f"20{digits(2)}-0{rng.randint(1, 9)}-1{digits(1)} 1{digits(1)}:2{digits(1)}:3{digits(1)}", f"{digits(1)}.{digits(2)}.{digits(1)}",
            f"{digits(3)}.{rng.randint(256, 999)}.{digits(2)}.{digits(1)}", f"${digits(3)},{digits(3)},{digits(3)}", f"{word()}-{digits(8)}", f"@{word()}", f"{digits(4)} {digits(4)}", f"{digits(3)}-{digits(2)}-{digits(2)}",
            f"look at {word()} dots {word()}", f"{digits(5)}-{digits(4)}", f"{digits(4)}/{digits(4)}/{digits(4)}", f"{digits(4)} {digits(4)} {digits(4)}", f"{digits(2)} {digits(3)} {digits(4)} {digits(2)}",
        ))

    text, spans = filler(), []
    for _ in range(rng.randint(1, 3)):
        kind = rng.choice((0, 1, 2, 3, 4, 4, 4))
        if kind < 4 and rng.random() < 0.4:
            text += " " + rng.choice(sorted(HINTS[KINDS[kind]])) + rng.choice((":", "", " is"))
        text += " "
        piece = (email, ip, card, phone, other)[kind]()
        if kind < 4:
            spans.append((len(text), len(text) + len(piece), kind))
        text += piece + rng.choice(("", ",", ".", ";")) + " " + filler()
    return text, spans


FIT_SENTENCES, FIT_EPOCHS = 500, 12


@functools.lru_cache(maxsize=1)
def fitted() -> Field:
    """Stochastic gradient ascent with averaged steps on the generated sentences."""
    rng, field, data = random.Random(5), Field(), []
    for _ in range(FIT_SENTENCES):
        text, spans = _sentence(rng)
        for start, end in islands(text):
            bounds, found = candidates(text, start, end)
            if found:
                places = [(i, j) for i, j, _ in found]
                f = np.array([features(s, text[max(0, bounds[i] - 20) : bounds[i]]) for i, _, s in found])
                gold = {(bounds.index(a), bounds.index(b), kind) for a, b, kind in spans if a in bounds and b in bounds}
                data.append((len(bounds) - 1, places, f, gold))
    squares = np.full_like(field.w, 1e-6)
    for _ in range(FIT_EPOCHS):
        rng.shuffle(data)
        for n, places, f, gold in data:
            g = field.gradient(n, places, f, gold) - 2e-3 * field.w
            squares += g * g
            field.w += 0.5 * g / np.sqrt(squares)
    return field


def added_spans(text: str, base: list[tuple[int, int, int]], field: Field) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the field's segments that touch no base span."""
    taken = [(a, b) for a, _, b in base]
    out = []
    for start, end in islands(text):
        bounds = token_bounds(text, start, end)
        for i, j, kind in field.decode(len(bounds) - 1, _scored(text, bounds, taken, field)):
            out.append((bounds[i], kind, bounds[j]))
    return out


def _scored(text: str, bounds: list[int], taken: list[tuple[int, int]], field: Field) -> Iterator[tuple[int, int, int, float]]:
    """An island's segments that touch none of ``taken`` (sorted by start) with their best
    kind and its score, by first token; only a piece's segments are held at a time."""
    behind = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0)
    starts = [a for a, _ in taken]

    def free(a: int, b: int) -> bool:
        k = bisect.bisect_left(starts, b)
        return not k or behind[k - 1] <= a

    for lo in range(0, len(bounds) - 1, PIECE_TOKENS):
        found = [(i, j, s) for i, j, s in segments(text, bounds, lo, lo + PIECE_TOKENS) if free(bounds[i], bounds[j])]
        if found:
            scores = field.scores(np.array([features(s, text[max(0, bounds[i] - 20) : bounds[i]]) for i, _, s in found]))
            for (i, j, _), kind, score in zip(found, scores.argmax(1), scores.max(1), strict=True):
                yield i, j, int(kind), score


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in sorted(spans))


RESULT = "struct<n_email:long,n_ip:long,n_card:long,n_phone:long,base_sha256:string,spans:string>"


def pii_spans(text: Column, field: Field) -> Column:
    ship(SparkSession.active())

    @F.arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        rows = []
        for t in column.fill_null("").to_pylist():
            base, more = [], []
            if any(c in t for c in "@0123456789") or "dot" in t or "DOT" in t:
                base = base_spans(t)
                more = added_spans(t, base, field)
            counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
            rows.append({**{f"n_{k}": n for k, n in zip(KINDS, counts, strict=True)}, "base_sha256": hashlib.sha256(written(base).encode()).hexdigest(), "spans": written(base + more)})
        kinds = [(f"n_{k}", pa.int64()) for k in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())]
        return pa.array(rows, pa.struct(kinds))

    return run(text)


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of
    the base spans, and spans: those and the field's, as kind:start:end in code points by
    start, then kind. A null or empty text has none. The field's segments hold at most
    LONGEST tokens and LONGEST_CHARS characters; islands and texts may have any length.
    Repeated rows give repeated results, an empty table none; other columns are ignored.
    """
    spans = pii_spans(F.col(text_col).cast("string"), fitted())
    return df.select(F.col(id_col).cast("long").alias("doc_id"), spans.alias("s")).select("doc_id", "s.*")


def mask_pii(df: DataFrame, text_col: str = "text", mask: str = "[{kind}]") -> DataFrame:
    """``df`` with every found span of its text replaced by its kind; null stays null."""
    field = fitted()
    ship(df.sparkSession)

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for t in column.to_pylist():
            if t:
                base = base_spans(t)
                last, parts = 0, []
                for a, kind, b in sorted(base + added_spans(t, base, field)):
                    if a >= last:
                        parts += [t[last:a], mask.format(kind=KINDS[kind])]
                        last = b
                t = "".join([*parts, t[last:]])
            out.append(t)
        return pa.array(out, pa.string())

    return df.withColumn(text_col, run(F.col(text_col)))
