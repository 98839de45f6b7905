"""Personal data by fixed patterns and a semi-Markov conditional random field.

Base spans come from four patterns (e-mail, IP address, payment card, phone) with
their checks (octets, Luhn, digit counts).  The patterns are searched in linear
time: an e-mail from its ``@`` outwards, runs of digits with possessive repeats.

The model adds what is written in other forms (spelled-out or defanged addresses,
IPv6, national phone numbers, cards with other separators).  It is a semi-Markov
CRF: a segmentation of a text's tokens into single tokens outside and entities of
at most ``MAX_TOKENS`` tokens and ``MAX_CHARS`` characters has the score

    sum over entities of w . f(kind, whole span, neighbours)  +  sum of t[label before][label]

and the Viterbi recursion over (end, label) chooses boundaries and kinds together.
Features see the whole span: its shape, group sizes, digit count, Luhn sum, octets,
separators, domain ending, the words around it.  Training maximises the exact
conditional log-likelihood (forward and backward over all segmentations) on
sentences that this module makes: marked entities of many forms and look-alikes
(dates, amounts, versions, codes) among random words, which are a fixed number and
don't depend on the corpus.  No document is used for training.

Candidates must hold an anchor (a digit, an at sign or a spelled-out mark), so only
the stretches around anchors are decoded; beyond them all tokens are outside in
every segmentation.  Stretches end at line ends, and long ones are decoded in parts
that are cut where no candidate crosses, so memory stays bounded whatever the text.
Base spans are fixed: no added span overlaps one.

Defined results: null or empty text has no spans; a null ``doc_id`` is carried
through; equal rows get equal results; an empty table gives an empty result; other
columns are ignored by ``find_spans`` and kept by ``redact``.  Places are code
points, ends exclusive.
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

from .common import require_columns

#: Fixed order of the kinds.
KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 24
MAX_CHARS = 100
#: Tokens that are decoded together (more where no clean cut is found).
PART = 2048
#: Sentences the model is trained on, and steps of its training.
SENTENCES = 1500
STEPS = 60

Span = tuple[str, int, int]

# --- base spans -------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, by start and then kind."""
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append(("email", start, end))
        else:
            end = max(end, at)  # nothing before this sign can belong to a later one
        at = text.find("@", max(at + 1, end))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# --- segments and features --------------------------------------------------

_TOKEN = re.compile(r"[^\W_]+|\s+|[\W_]")
_MARK = r"[(\[{<]\s?(?:at|dot|punkt|arroba|punto|point)\s?[)\]}>]|(?<=\s)(?:dot|punkt|punto|point)(?=\s)|\[\.\]|\(\.\)|\(@\)|\[@\]"
_ANCHOR = re.compile(rf"[0-9]|@|{_MARK}", re.I)
_AT = re.compile(r"@|[(\[{<]\s?(?:at|@|arroba)\s?[)\]}>]|\s(?:at|arroba)\s", re.I)
_DOT = re.compile(r"\.|[(\[{<]\s?(?:dot|punkt|punto|point|\.)\s?[)\]}>]|\s(?:dot|punkt|punto|point)\s", re.I)
_PHONE_CHARS = re.compile(r"[+(]?[0-9][0-9 ().+/\u00a0-]*[0-9]")
_CARD_CHARS = re.compile(r"[0-9][0-9 ./_*\u00a0-]*[0-9]")
_IP_CHARS = re.compile(r"[0-9A-Fa-f:\[][0-9A-Fa-f.:\[\]() ]*[0-9A-Fa-f:]|[0-9]+(?:\s?[(\[]?\s?dot\s?[)\]]?\s?[0-9]+){3}", re.I)
_IP_PARTS = re.compile(r"\s?[(\[]?\s?(?:\.|dot)\s?[)\]]?\s?", re.I)
_EMAIL_CHARS = re.compile(r"[^\W_][\w.%+\-@()\[\]{}<> ]*[^\W_]")
_DIGIT = re.compile(r"[0-9]+")
_WORD = re.compile(r"[^\W\d_]+")
_SEPARATORS = str.maketrans("", "", "0123456789")


def shape(span: str) -> str:
    """Runs of digits with their length, runs of letters as ``a``, other characters as they are."""
    out = []
    for t in _TOKEN.findall(span):
        if t[0].isspace():
            out.append("_")
        elif t.isascii() and t.isdigit():
            out.append(f"9{len(t)}")
        elif t[0].isalnum():
            out.append("x" if re.fullmatch(r"[0-9A-Fa-f]{1,4}", t) and not t.isalpha() else "a")
        else:
            out.append(t)
    return "".join(out)[:60]


def _kinds_for(span: str) -> list[str]:
    """Kinds whose characters and least structure the span has; the others are no candidates."""
    digits = sum("0" <= c <= "9" for c in span)
    kinds = []
    if _EMAIL_CHARS.fullmatch(span) and len(at := _AT.findall(span)) == 1 and _DOT.search(span, _AT.search(span).end()):
        kinds.append("email")
    if _IP_CHARS.fullmatch(span) and (span.count(":") >= 2 or len(_IP_PARTS.split(span)) == 4 and digits >= 4):
        kinds.append("ip")
    if 12 <= digits <= 19 and _CARD_CHARS.fullmatch(span):
        kinds.append("card")
    if 7 <= digits <= 15 and _PHONE_CHARS.fullmatch(span):
        kinds.append("phone")
    return kinds


def _span_features(kind: str, span: str) -> list[str]:
    digits = "".join(_DIGIT.findall(span))
    groups = [len(g) for g in _DIGIT.findall(span)]
    marks = "".join(sorted(set(span.translate(_SEPARATORS)))) if kind in ("card", "phone") else ""
    out = ["bias", f"shape={shape(span)}", f"n={len(digits)}", f"groups={len(groups)}", f"first={shape(span[:1])}", f"last={shape(span[-1:])}"]
    if kind == "card":
        out += [f"luhn={luhn(digits)}", f"sizes={'-'.join(map(str, groups[:6]))}", f"marks={marks}", f"luhn={luhn(digits)},marks={len(marks)}",
                f"even={len(set(groups)) == 1}", f"lead={digits[:1]}"]
    elif kind == "phone":
        out += [f"sizes={'-'.join(map(str, groups[:6]))}", f"marks={marks}", f"zero={digits[:2] == '00'}{digits[:1] == '0'}",
                f"year={bool(re.match(r'(19|20)[0-9][0-9]$', span[:4] if len(groups) and groups[0] == 4 else ''))}",
                f"lastsize={groups[-1] if groups else 0}"]
    elif kind == "ip":
        if ":" in span:
            parts = span.split(":")
            ok = all(re.fullmatch("[0-9A-Fa-f]{0,4}", p) for p in parts) and (len(parts) == 8 and "" not in parts or span.count("::") == 1 and len(parts) <= 8)
            hexed = any(len(p) > 2 for p in parts)
            out += [f"v6={ok}", f"v6={ok},long={hexed}", f"parts={len(parts)}", f"pairs={all(len(p) == 2 for p in parts)}"]
        else:
            parts = _IP_PARTS.split(span)
            ok = len(parts) == 4 and all(p.isdigit() and _octet(p) for p in parts)
            out += [f"v4={ok}", f"defanged={bool(re.search(r'[()[]', span))}", f"even={len(set(re.findall(r'[^0-9]+', span))) == 1}"]
    else:
        at, dot = _AT.search(span), _DOT.search(span, _AT.search(span).end())
        local, ending = span[:at.start()], _WORD.findall(span[dot.end():])
        out += [f"at={re.sub(r'[a-z]+', 'a', at.group().lower())}", f"dot={re.sub(r'[a-z]+', 'a', dot.group().lower())}",
                f"words={min(len(local.split()), 4)}", f"ending={len(ending[-1]) if ending else 0}", f"dots={min(len(_DOT.findall(span)), 5)}",
                f"loose={min(len(_DOT.sub('', span[at.end():]).split()) , 4)}", f"tld={ending[-1].lower() if ending else ''}",
                f"lone={' ' in _DOT.sub('.', local).strip()}"]
    return out


def _around(kind: str, tokens: list[str], i: int, j: int) -> list[str]:
    """Features of the neighbours of tokens i to j."""
    before, after = tokens[i - 1] if i else "", tokens[j] if j < len(tokens) else ""

    def sort(t: str) -> str:
        return "" if not t else "_" if t.isspace() else "9" if t.isascii() and t.isdigit() else "a" if t[0].isalnum() else t

    out = [f"before={sort(before)}", f"after={sort(after)}"]
    if before and not before.isspace() and i > 1:
        out.append(f"before2={sort(tokens[i - 2])}{sort(before)}")
    if after and not after.isspace() and j + 1 < len(tokens):
        out.append(f"after2={sort(after)}{sort(tokens[j + 1])}")
    cues = [t.lower() for t in tokens[max(0, i - 8):i] if t.isalpha()]
    out += [f"cue={c}" for c in set(cues[-3:])]
    return out + [f"next={t.lower()}" for t in tokens[j:j + 2] if t.isalpha()]


def features(kind: str, tokens: list[str], i: int, j: int) -> list[str]:
    span = "".join(tokens[i:j])
    return [f"{kind}:{f}" for f in (*_span_features(kind, span), *_around(kind, tokens, i, j))]


def candidates(tokens: list[str], blocked: list[bool], upto: int | None = None) -> Iterator[tuple[int, int, str]]:
    """``(i, j, kind)``: segments that may be entities, by start; ``upto`` ends the starts."""
    n = len(tokens)
    anchor = np.zeros(n + 1, np.int64)
    text, at = "".join(tokens), np.cumsum([0, *map(len, tokens)])
    for m in _ANCHOR.finditer(text):
        anchor[np.searchsorted(at, m.start(), "right")] += 1
    anchor = anchor.cumsum()  # anchors that begin in the first k tokens
    barrier = [blocked[k] or "\n" in t or "\r" in t for k, t in enumerate(tokens)]
    for i in range(n if upto is None else upto):
        if barrier[i] or tokens[i].isspace() or anchor[min(n, i + MAX_TOKENS)] == anchor[i]:
            continue
        for j in range(i + 1, min(n, i + MAX_TOKENS) + 1):
            if barrier[j - 1] or at[j] - at[i] > MAX_CHARS:
                break
            if anchor[j] > anchor[i] and not tokens[j - 1].isspace():
                for kind in _kinds_for(text[at[i]:at[j]]):
                    yield i, j, kind


# --- model ------------------------------------------------------------------

@dataclass
class Model:
    weights: dict[str, float]
    moves: np.ndarray  # label before x label; label 0 is outside

    def score(self, kind: str, tokens: list[str], i: int, j: int) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features(kind, tokens, i, j))

    def decode(self, tokens: list[str], found: list[tuple[int, int, str]], n: int) -> list[tuple[int, int, str]]:
        """The best segmentation's entities among ``found``, over the first ``n`` tokens."""
        ends: dict[int, list[tuple[int, int, float]]] = {}
        for i, j, kind in found:
            ends.setdefault(j, []).append((i, KINDS.index(kind) + 1, self.score(kind, tokens, i, j)))
        moves = self.moves.tolist()
        labels = range(len(KINDS) + 1)
        best = [[0.0] + [float("-inf")] * len(KINDS)]
        back: list[list[tuple[int, int] | None]] = [[None] * len(best[0])]

        def into(i: int, label: int) -> tuple[float, int]:
            return max((best[i][k] + moves[k][label], -k) for k in labels)

        for t in range(1, n + 1):
            s, k = into(t - 1, 0)
            row, how = [s] + [float("-inf")] * len(KINDS), [(t - 1, -k)] + [None] * len(KINDS)
            for i, label, score in ends.get(t, ()):
                s, k = into(i, label)
                if s + score > row[label]:
                    row[label], how[label] = s + score, (i, -k)
            best.append(row)
            back.append(how)
        out, t = [], n
        label = max(labels, key=lambda k: (best[n][k], -k))
        while t:
            i, before = back[t][label]
            if label:
                out.append((i, t, KINDS[label - 1]))
            t, label = i, before
        return out[::-1]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.squeeze(np.log(np.exp(x - safe).sum(axis=axis, keepdims=True)) + safe, axis)


class Lattices:
    """All segmentations of all sentences, for the likelihood and its gradient."""

    def __init__(self, lengths: list[int], rows: list[tuple[int, int, int, int]]):
        self.n = np.array(lengths)
        cand = np.array(rows, np.int64).reshape(-1, 4)  # sentence, i, j, label
        self.e, self.i, self.j, self.k = cand.T
        top = int(self.n.max())
        self.by_end = [np.nonzero(self.j == t)[0] for t in range(top + 1)]
        self.by_start = [np.nonzero(self.i == t)[0] for t in range(top + 1)]

    def expected(self, score: np.ndarray, moves: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Sum of log partition functions, each candidate's probability, expected label pairs."""
        rows, top, labels = len(self.n), int(self.n.max()), len(moves)
        alpha = np.full((rows, top + 1, labels), -np.inf)
        alpha[:, 0, 0] = 0.0
        for t in range(1, top + 1):
            alpha[:, t, 0] = _lse(alpha[:, t - 1] + moves[:, 0], 1)
            c = self.by_end[t]
            if len(c):
                into = _lse(alpha[self.e[c], self.i[c]] + moves[:, self.k[c]].T, 1) + score[c]
                np.logaddexp.at(alpha[:, t], (self.e[c], self.k[c]), into)
        z = _lse(alpha[np.arange(rows), self.n], 1)
        beta = np.full((rows, top + 1, labels), -np.inf)
        for t in range(top, -1, -1):
            last = self.n == t
            beta[last, t] = 0.0
            inner = self.n > t
            if t < top:
                beta[inner, t] = moves[:, 0] + beta[inner, t + 1, 0][:, None]
            c = self.by_start[t]
            if len(c):
                ahead = score[c] + beta[self.e[c], self.j[c], self.k[c]]
                for label in range(labels):
                    np.logaddexp.at(beta[:, t, label], self.e[c], moves[label, self.k[c]] + ahead)
        after = (score + beta[self.e, self.j, self.k] - z[self.e])[:, None]
        with np.errstate(under="ignore"):
            pair = np.exp(alpha[self.e, self.i] + moves[:, self.k].T + after)
            moved = np.zeros_like(moves)
            np.add.at(moved.T, self.k, pair)
            for t in range(1, top + 1):
                inner = self.n >= t
                moved[:, 0] += np.exp(alpha[inner, t - 1] + moves[:, 0] + (beta[inner, t, 0] - z[inner])[:, None]).sum(axis=0)
        return float(z.sum()), pair.sum(axis=1), moved


def train(sentences: list[tuple[list[str], list[tuple[int, int, str]]]], steps: int = STEPS, rate: float = 0.15,
          keep: float = 2e-3, least: int = 3) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam over all sentences."""
    lengths, rows, gold, texts = [], [], [], []
    counted: dict[str, int] = {}
    for tokens, entities in sentences:
        found = list(candidates(tokens, [False] * len(tokens)))
        if not set(entities) <= set(found):
            continue
        e = len(lengths)
        lengths.append(len(tokens))
        for i, j, kind in found:
            rows.append((e, i, j, KINDS.index(kind) + 1))
            gold.append((i, j, kind) in entities)
            texts.append(features(kind, tokens, i, j))
            for f in texts[-1]:
                counted[f] = counted.get(f, 0) + 1
    names = {f: k for k, f in enumerate(f for f, n in counted.items() if n >= least)}
    owner = np.repeat(np.arange(len(rows)), [sum(f in names for f in t) for t in texts])
    index = np.array([names[f] for t in texts for f in t if f in names], np.int64)
    lattice, is_gold, size, labels = Lattices(lengths, rows), np.array(gold), len(names), len(KINDS) + 1
    seen_moves = np.zeros((labels, labels))
    by: dict[int, list[tuple[int, int, int]]] = {}
    for (e, i, j, k), g in zip(rows, gold):
        if g:
            by.setdefault(e, []).append((i, j, k))
    for e, n in enumerate(lengths):
        t = label = 0
        for i, j, k in [*sorted(by.get(e, [])), (n, n, -1)]:
            while t < i:
                seen_moves[label, 0] += 1
                t, label = t + 1, 0
            if k > 0:
                seen_moves[label, k] += 1
                t, label = j, k
    x = np.zeros(size + labels * labels)
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        w, moves = x[:size], x[size:].reshape(labels, labels)
        score = np.bincount(owner, w[index], len(rows))
        _, p, moved = lattice.expected(score, moves)
        slope = np.concatenate([np.bincount(index, (is_gold - p)[owner], size), (seen_moves - moved).ravel()]) / len(lengths) - keep * x
        m, v = 0.9 * m + 0.1 * slope, 0.98 * v + 0.02 * slope ** 2
        x = x + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.98 ** step)) + 1e-8)
    return Model({f: float(x[k]) for f, k in names.items()}, x[size:].reshape(labels, labels).copy())


# --- training sentences -----------------------------------------------------

#: Words that stand near personal data, and endings of domains.
CUES = {"email": ("mail", "email", "contact", "write", "kontakt", "correo", "courriel"), "ip": ("ip", "host", "server", "address", "from"),
        "card": ("card", "visa", "payment", "karte", "tarjeta", "carte"), "phone": ("phone", "tel", "call", "fax", "mobile", "telefon")}
ENDINGS = ("com", "org", "net", "edu", "de", "fr", "es", "io", "co", "info")


class Maker:
    """Sentences with marked entities and look-alikes, from one random generator."""

    def __init__(self, seed: int = 1):
        self.r = np.random.default_rng(seed)

    def pick(self, *options):
        return options[self.r.integers(len(options))]

    def digits(self, n: int, lead: str = "0123456789") -> str:
        return lead[self.r.integers(len(lead))] + "".join(map(str, self.r.integers(0, 10, n - 1))) if n else ""

    def word(self) -> str:
        n = int(self.r.integers(1, 9))
        w = "".join("etaoinshrdlucmfwypvbgkjäéñ"[min(25, int(k))] for k in self.r.exponential(6, n))
        return self.pick(w, w, w, w.capitalize(), w.upper())

    def name(self) -> str:
        return "".join("etaoinshrdlucmfwypvbgkj"[int(k)] for k in self.r.integers(0, 23, int(self.r.integers(2, 9))))

    def email(self) -> str:
        local = self.pick(self.name(), f"{self.name()}.{self.name()}", f"{self.name()}_{self.name()}", f"{self.name()}{self.digits(2)}", f"{self.name()}.{self.digits(2)}")
        host = [self.pick(self.name(), f"{self.name()}{self.digits(1)}", f"{self.name()}-{self.name()}"), ENDINGS[self.r.integers(len(ENDINGS))]]
        if self.r.random() < 0.3:
            host.insert(0, self.name())
        at = self.pick("(at)", "[at]", " (at) ", " [at] ", " at ", " AT ", " @ ", "{at}", "(@)", "@")
        dot = self.pick("(dot)", "[dot]", " dot ", " DOT ", " [dot] ", " (dot) ", "[.]", "(.)") if at in (" at ", " AT ", "@") else self.pick(".", ".", "(dot)", "[dot]", " dot ", " . ", "[.]")
        if self.r.random() < 0.5:
            local = local.replace(".", dot)
        return local + at + dot.join(host)

    def ip(self) -> str:
        if self.r.random() < 0.5:
            return self.pick("[.]", "(.)", " . ", "[dot]", "(dot)", " dot ").join(str(self.r.integers(0, 256)) for _ in range(4))
        parts = [f"{int(v):x}" for v in self.r.integers(0, 65536, 8)]
        if self.r.random() < 0.5:
            cut = int(self.r.integers(1, 5))
            return ":".join(parts[:cut]) + "::" + ":".join(parts[cut:cut + int(self.r.integers(1, 4))])
        return ":".join(parts)

    def number(self, valid: bool) -> str:
        n = int(self.pick(13, 15, 16, 16, 16, 16, 18))
        d = self.digits(n, "3456")
        for last in "0123456789":
            if luhn(d[:-1] + last) == valid:
                d = d[:-1] + last
                break
        sep = self.pick(".", "/", "_", "  ", " - ", "\u00a0", "") if n != 13 else self.pick("", " ", "-", ".")
        if n == 15:
            return sep.join((d[:4], d[4:10], d[10:]))
        return sep.join(d[k:k + 4] for k in range(0, n, 4))

    def phone(self) -> str:
        a, b, c = self.digits(3, "23456789"), self.digits(3), self.digits(4)
        d = self.digits(int(self.r.integers(6, 9)))
        city, land = self.digits(int(self.r.integers(2, 4)), "123456789"), self.pick("49", "33", "34", "44", "41")
        return self.pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"1 ({a}) {b}-{c}", f"({a}) {b} {c}", f"00{land} {city} {d}",
                         f"00{land}-{city}-{d}", f"0{city} {d}", f"0{city}/{d}", f"(0{city}) {d}", f"0{city}-{d}", f"0{city} {d[:2]} {d[2:4]} {d[4:6]} {d[6:]}".strip())

    def look_alike(self) -> str:
        """Numbers and marks that are no personal data."""
        d = self.digits
        year = f"{self.pick(19, 20)}{d(2)}"
        hexed = "".join("0123456789abcdef"[k] for k in self.r.integers(0, 16, int(self.r.integers(8, 40))))
        return self.pick(
            f"{year}-{self.r.integers(1, 13):02d}-{self.r.integers(1, 29):02d}", f"{self.r.integers(1, 29)}.{self.r.integers(1, 13)}.{year}",
            f"{self.r.integers(1, 13)}/{self.r.integers(1, 29)}/{year}", f"{self.r.integers(0, 24)}:{d(2)}:{d(2)}", f"{year}-{year}", f"{year}, {year}, {year} {year}",
            f"{d(1)}.{d(1)}.{d(2)}", f"{d(2)}.{d(1)}.{d(3)}.{d(4, '3456789')}", f"{d(3)},{d(3)},{d(3)}.{d(2)}", f"{d(1, '123456789')} {d(3)} {d(3)}", f"{d(2)}.{d(3)}.{d(3)},{d(2)}",
            f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{d(2)}-{d(2)}", f"{d(5)}", f"{d(3)}", f"{d(8)}", f"{d(9)}", f"{d(10)}", f"{d(12)}", f"{d(20)}", f"No. {d(7)}",
            f"Version {d(1)}.{d(1)}", hexed, f'token = "{hexed}"', f"0x{hexed[:8]}", self.number(False), self.number(False), self.digits(16), f"{d(4)}/{d(4)}/{d(4)}/{d(4)}",
            f"@{self.name()}", f"{self.name()}@{self.name()}", f"{self.name()} at {self.name()}", f"{self.name()} at {d(1)}.{d(2)} {self.name()}",
            f"{self.name()} at {d(2)}:{d(2)} pm. {self.name()}", f"{self.name()} dot {self.name()}", f"{':'.join(d(2) for _ in range(6))}",
            f"{d(3)}:{d(3)}:{d(3)}", f"{d(3)}.{d(3)}", f"[{d(2)}]", f"({year})", f"{d(2)} {d(2)} {d(2)} {d(2)}", f"{d(1)} x {d(3)} x {d(3)}", f"{self.name()} at the dot {self.name()}",
            f"{d(2)}:{d(2)} - {d(2)}:{d(2)}", f"{d(4)} {d(4)}", f"${d(4)}.{d(2)}", f"{d(3)} 000 {d(3)} 000")

    def sentence(self) -> tuple[list[str], list[tuple[int, int, str]]] | None:
        parts: list[tuple[str, str | None]] = []
        for _ in range(int(self.r.integers(0, 6))):
            parts.append((self.word() + self.pick(" ", " ", " ", ", ", ". "), None))
        for _ in range(int(self.pick(1, 1, 2))):
            if self.r.random() < 0.5:
                kind = KINDS[self.r.integers(len(KINDS))]
                if self.r.random() < 0.35:
                    parts.append((CUES[kind][self.r.integers(len(CUES[kind]))] + self.pick(" ", ": ", ":"), None))
                value = {"email": self.email, "ip": self.ip, "card": lambda: self.number(True), "phone": self.phone}[kind]()
                parts.append((value, kind))
            else:
                parts.append((self.look_alike(), None))
            parts.append((self.pick(" ", " ", ". ", ", ", "; ", "! ", ") ", "%%% ", " | "), None))
            for _ in range(int(self.r.integers(0, 5))):
                parts.append((self.word() + self.pick(" ", " ", ". "), None))
        text = "".join(p for p, _ in parts)
        if base_spans(text):
            return None
        at, marked = 0, []
        for p, kind in parts:
            if kind:
                marked.append((kind, at, at + len(p)))
            at += len(p)
        tokens, place = tokens_of(text, 0, len(text))
        starts, ends = {p: k for k, p in enumerate(place)}, {p + len(t): k + 1 for k, (p, t) in enumerate(zip(place, tokens))}
        if any(a not in starts or b not in ends for _, a, b in marked):
            return None
        return tokens, [(starts[a], ends[b], kind) for kind, a, b in marked]


def made(count: int, seed: int = 1) -> list[tuple[list[str], list[tuple[int, int, str]]]]:
    maker, out = Maker(seed), []
    while len(out) < count:
        s = maker.sentence()
        if s:
            out.append(s)
    return out


def trained(sentences: int = SENTENCES, steps: int = STEPS, seed: int = 1) -> Model:
    return train(made(sentences, seed), steps)


# --- texts ------------------------------------------------------------------

def tokens_of(text: str, start: int, end: int) -> tuple[list[str], list[int]]:
    tokens, place = [], []
    for m in _TOKEN.finditer(text, start, end):
        tokens.append(m.group())
        place.append(m.start())
    return tokens, place


def stretches(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """Ranges around anchors outside base spans; nothing else can touch a candidate."""
    begin = end = -1
    k, covered = 0, 0
    for m in _ANCHOR.finditer(text):
        a, b = m.span()
        while k < len(base) and base[k][1] <= a:
            covered = max(covered, base[k][2])
            k += 1
        if a < covered:
            continue
        lo, hi = max(0, a - MAX_CHARS - 20), min(len(text), b + MAX_CHARS + 20)
        if lo > end:
            if end >= 0:
                yield begin, end
            begin = lo
        end = max(end, hi)
    if end >= 0:
        yield begin, end


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """What the model finds beside the base spans."""
    out: list[Span] = []
    for lo, hi in stretches(text, base):
        scan = _TOKEN.finditer(text, lo, hi)
        tokens: list[str] = []
        place: list[int] = []
        size, more = PART, True
        while more or tokens:
            while more and len(tokens) < size:
                m = next(scan, None)
                more = m is not None
                if more:
                    tokens.append(m.group())
                    place.append(m.start())
            blocked = _blocked(place, tokens, base)
            n = len(tokens)
            starts = n if not more else max(0, n - MAX_TOKENS)
            found = list(candidates(tokens, blocked, starts))
            cut = n
            if more:  # the last place that no candidate crosses
                crossed = np.zeros(n + 2, np.int64)
                for i, j, _ in found:
                    crossed[i + 1] += 1
                    crossed[j] -= 1
                free = np.nonzero(crossed.cumsum()[:starts + 1] == 0)[0]
                cut = int(free[-1])
            if cut <= 1 and more:
                size *= 2
                continue
            keep = [c for c in found if c[1] <= cut]
            out += [(kind, place[i], place[j - 1] + len(tokens[j - 1])) for i, j, kind in model.decode(tokens, keep, cut)] if keep else []
            # one token stays as the neighbour of the next part
            stay = cut - 1 if more else n
            tokens, place, size = tokens[stay:], place[stay:], PART
    return out


def _blocked(place: list[int], tokens: list[str], base: list[Span]) -> list[bool]:
    out = [False] * len(tokens)
    if not tokens:
        return out
    end = place[-1] + len(tokens[-1])
    for _, a, b in base:
        if a < end and b > place[0]:
            lo = max(0, int(np.searchsorted(place, a, "right")) - 1)
            for k in range(lo, len(tokens)):
                if place[k] >= b:
                    break
                out[k] = out[k] or place[k] + len(tokens[k]) > a
    return out


def spans_of(text: str | None, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, both by start and then kind."""
    base = base_spans(text) if text else []
    every = sorted([*base, *(added_spans(text, base, model) if text else [])], key=lambda s: (s[1], KINDS.index(s[0])))
    return base, every


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """A row for each row of ``docs``.

    ``doc_id, n_email, n_ip, n_card, n_phone`` (base spans of each kind),
    ``base_sha256`` (of the joined base spans), ``spans`` (all, joined
    ``kind:start:end``), ``n_added`` (spans that the model adds).
    """
    require_columns(docs, ["doc_id", "text"])
    shared = docs.sparkSession.sparkContext.broadcast(model or trained())
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                base, every = spans_of(text.as_py(), own)
                count = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((doc_id, *count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), len(every) - len(base)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 8, types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def masked(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span (overlapping ones together) replaced by the first one's kind in brackets."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with all spans in ``text`` masked; other columns and the schema unchanged."""
    require_columns(docs, ["text"])
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [masked(t.as_py(), spans_of(t.as_py(), shared.value)[1]) for t in b.column(at)]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
