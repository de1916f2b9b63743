"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds the spans they miss."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import map_arrow

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """The leftmost matches of local part, @ and dotted domain: the local part can only end at an @, so each @ is looked at in turn."""
    done, at = 0, text.find("@")
    while at >= 0:
        if (m := _DOMAIN.match(text, at + 1)) and (n := _LOCAL.search(text, max(done, at - 1_000), at)):
            start = n.start()
            if start == at - 1_000 and start > done:  # a very long local part
                start = _LOCAL.search(text, done, at).start()
            yield "email", start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) by kind, then start: leftmost matches of each pattern, those that fail its test dropped."""
    out = list(_emails(text)) if "@" in text else []
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(z := p.lstrip("0") or "0") <= 3 and int(z) <= 255 for p in m.group().split("."))]
    out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


# ---- the semi-Markov field ----
#: Tokens of a segment at most, and characters of merged windows: entities are bounded, and so is the work.
MOST_TOKENS, MOST_WINDOW = 24, 2_000
#: Posterior probability from which a span is added; training texts, passes and seed.
CERTAIN, EXAMPLES, PASSES, SEED = 0.5, 400, 60, 3
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\w\s]|_|[^\S\n]+|\n")
#: What makes a window worth a look: a run of digits that could be a number of somebody's, or a written-out @.
_TRIGGER = re.compile(r"[0-9][0-9 ().+/-]{5,}[0-9]|[0-9]+(?: ?\. ?[0-9]+){3}|\[\.\]|@|[\[({] ?at ?[\])}]|\bat\b(?=[^.\n]{1,40}\bdot\b)", re.IGNORECASE)
_CUES = {
    "email": {"email", "mail", "contact", "write", "address", "correo", "courriel", "e"},
    "ip": {"ip", "host", "server", "address", "ping", "addr", "login"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "payment", "karte", "tarjeta", "carte"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "cell", "whatsapp", "ring"},
}
_OTHER_CUES = {"order", "isbn", "invoice", "id", "part", "serial", "version", "no", "ref", "room", "page", "figure", "year", "issn", "doi", "build"}
_TOP = {"com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "uk", "us", "eu", "de", "fr", "es", "it", "nl", "ch", "at", "be", "pt", "pl", "se", "jp", "cn", "in", "br", "mx", "ca", "au"}
_AT, _DOT = r"(?:@| ?[\[({] ?at ?[\])}] ?| at )", r"(?:\.| ?[\[({] ?dot ?[\])}] ?| dot )"
_EMAIL_LIKE = re.compile(rf"[\w%+-]+(?:{_DOT}[\w%+-]+)*{_AT}[\w-]+(?:{_DOT}[\w-]+)*{_DOT}[^\W\d_]{{2,}}", re.IGNORECASE)
_PHONE_LIKE = re.compile(r"(?:\+|00)?[0-9]{0,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ ./-]?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}")
_CARD_LIKE = re.compile(r"[0-9]{4}(?:[ .-][0-9]{4}){3}|[0-9]{4}[ .-][0-9]{6}[ .-][0-9]{5}|[0-9]{13,19}")
_IP_LIKE = re.compile(r"[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}|[0-9]{1,3}(?: ?\[\.\] ?[0-9]{1,3}){3}")
_LIKE = dict(zip(KINDS, (_EMAIL_LIKE, _IP_LIKE, _CARD_LIKE, _PHONE_LIKE)))


def tokens(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def _features(text: str, start: int, end: int, kind: str, before: list[str]) -> list[str]:
    """Names of a candidate's features, all about the span as a whole and the words before it."""
    span = text[start:end]
    digits = _digits(span)
    out = [f"{kind}:bias", f"{kind}:digits:{min(len(digits), 20)}", f"{kind}:like:{bool(_LIKE[kind].fullmatch(span))}"]
    if kind == "email":
        out += [f"email:plain_at:{'@' in span}", f"email:top:{re.split('[^a-z]', span.lower())[-1] in _TOP}"]
    elif kind == "ip":
        parts = [p for p in re.split(r"[^0-9]+", span) if p]
        out.append(f"ip:bytes:{len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)}")
    elif kind == "card":
        out += [f"card:luhn:{13 <= len(digits) <= 19 and luhn(digits)}", f"card:split:{not span.isdigit()}"]
    else:
        shape = re.sub(r"[0-9]+", "9", span)
        out += [f"phone:lead:{span[:1] if span[:1] in '+(' else span[:2] if span[:2] == '00' else '9'}", f"phone:separators:{min(len(shape) - shape.count('9'), 6)}"]
    left, right = text[max(0, start - 1) : start], text[end : end + 2]
    goes_on = right[:1].isalnum() or right[:1] in ("@", "_") or (right[:1] in (".", "-") and right[1:].isalnum())
    out.append(f"{kind}:cut:{left.isalnum() or (left != '' and left in '@_.-+%') or goes_on}")
    out.append(f"{kind}:cue:{bool(_CUES[kind].intersection(before))}")
    out.append(f"{kind}:other:{bool(_OTHER_CUES.intersection(before))}")
    return out


def candidates(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int, str, list[str]]]]:
    """The tokens, and (first token, token after the last, kind, features) of every span of at most MOST_TOKENS that could be of a kind."""
    toks = tokens(text)
    words = [text[a:b].lower() for a, b in toks]
    found = []
    for i, (start, _) in enumerate(toks):
        if words[i].isspace():
            continue
        before = [w for w in words[max(0, i - 6) : i] if w.isalpha()][-3:]
        for j in range(i + 1, min(i + MOST_TOKENS, len(toks)) + 1):
            end = toks[j - 1][1]
            if words[j - 1] == "\n":
                break
            if words[j - 1].isspace():
                continue
            span = text[start:end]
            n = sum("0" <= c <= "9" for c in span)
            if n >= 7 and not re.search(r"[^0-9 ().+/\-\[\]]", span):
                found += [(i, j, k, _features(text, start, end, k, before)) for k in ("card", "phone")]
            if n >= 4 and j - i >= 7 and not re.search(r"[^0-9 .\[\]]", span):
                found.append((i, j, "ip", _features(text, start, end, "ip", before)))
            if j - i >= 5 and words[i].isalnum() and words[j - 1].isalpha() and ("@" in span or re.search(r"\bat\b", span, re.IGNORECASE)):
                found.append((i, j, "email", _features(text, start, end, "email", before)))
    return toks, found


def _by_end(found: list, scores: np.ndarray) -> dict[int, list[tuple[int, int, float]]]:
    out: dict[int, list[tuple[int, int, float]]] = {}
    for n, (i, j, _, _) in enumerate(found):
        out.setdefault(j, []).append((n, i, float(scores[n])))
    return out


def marginals(length: int, found: list, scores: np.ndarray) -> tuple[np.ndarray, float]:
    """Posterior probability of each candidate over all segmentations (a token outside entities scores 0), and the log partition."""
    ends = _by_end(found, scores)
    starts: dict[int, list[tuple[int, int, float]]] = {}
    for n, (i, j, _, _) in enumerate(found):
        starts.setdefault(i, []).append((n, j, float(scores[n])))
    ahead, behind = np.zeros(length + 1), np.zeros(length + 1)
    for j in range(1, length + 1):
        ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[i] + s for _, i, s in ends[j])]) if j in ends else ahead[j - 1]
    for i in range(length - 1, -1, -1):
        behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[j] + s for _, j, s in starts[i])]) if i in starts else behind[i + 1]
    p = np.array([np.exp(ahead[i] + scores[n] + behind[j] - ahead[length]) for n, (i, j, _, _) in enumerate(found)])
    return p, float(ahead[length])


def decode(length: int, found: list, scores: np.ndarray) -> list[int]:
    """The best segmentation by dynamic programming over token positions: boundaries and kinds at once. Ties prefer no entity."""
    ends, best, back = _by_end(found, scores), [0.0] * (length + 1), [-1] * (length + 1)
    for j in range(1, length + 1):
        best[j] = best[j - 1]
        for n, i, s in ends.get(j, ()):
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, n
    out, j = [], length
    while j > 0:
        if back[j] >= 0:
            out.append(back[j])
            j = found[back[j]][0]
        else:
            j -= 1
    return out[::-1]


def _examples(n: int, seed: int) -> list[tuple[str, list[Span]]]:
    """Generated lines with their spans: the forms people write the four kinds in, and numbers that are none of them."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    num = lambda k: "".join(str(int(x)) for x in rng.integers(0, 10, k))
    word = lambda: "".join(pick("abcdefghijklmnopqrstuvwxyz") for _ in range(int(rng.integers(2, 9))))

    def card() -> str:
        d = pick("3456") + num(14)
        d += next(str(c) for c in range(10) if luhn(d + str(c)))
        sep = pick(["", " ", "-", "."])
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    def email() -> str:
        at, dot = pick([("@", "."), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), ("[at]", ".")])
        return f"{word()}{pick(['', '.', '_', dot]) or ''}{word()}{at}{word()}{dot}{pick(['com', 'org', 'net', 'de', 'fr', 'es', 'io'])}"

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return pick([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{pick(['44', '49', '33', '34'])} {num(3)} {num(3)} {num(4)}", f"+49 {num(3)} {num(7)}", f"1-{a}-{b}-{c}", f"{a} {b} {c}"])

    def ip() -> str:
        sep = pick([".", ".", "[.]", " . "])
        return sep.join(str(int(x)) for x in rng.integers(0, 256, 4))

    def none() -> str:
        return pick([num(int(rng.integers(7, 13))), f"{num(4)}-{num(2)}-{num(2)}", f"{num(4)}-{num(4)}", f"{num(1)}.{num(1)}.{num(2)}.{num(4)}", f"{num(3)}-{num(1)}-{num(4)}-{num(4)}-{num(1)}", f"we met at {word()} and saw a dot {word()}", f"{num(2)}.{num(2)}.{num(4)} {num(2)}", f"0.{num(8)}", f"{num(24)}", f"sit at the {word()} dot {word()}", f"{word()} at {word()} dot {word()}"])

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    out = []
    for _ in range(n):
        text, spans = " ".join(word() for _ in range(int(rng.integers(1, 6)))), []
        for _ in range(int(rng.integers(1, 3))):
            if rng.random() < 0.4:
                text += pick(["", *(f" {c}" for c in sorted(_OTHER_CUES))]) + " " + none()
            else:
                kind = pick(KINDS)
                made = makers[kind]()
                cue = pick(sorted(_CUES[kind] - {"e"})) if rng.random() < 0.5 or (kind == "phone" and made.replace(" ", "").isdigit()) else ""
                text += f" {cue}{pick(['', ':'])} " if cue else " "
                spans.append((kind, len(text), len(text) + len(made)))
                text += made
            text += pick(["", ",", "."]) + "".join(f" {word()}" for _ in range(int(rng.integers(1, 4))))
        out.append((text, spans))
    return out


@cache
def train(examples: int = EXAMPLES, passes: int = PASSES, seed: int = SEED) -> dict[str, float]:
    """Feature weights by maximum likelihood: AdaGrad on the segmentations of generated lines, the same for the same seed."""
    data, index = [], {}
    for text, spans in _examples(examples, seed):
        toks, found = candidates(text)
        truth = {(a, b, k) for k, a, b in spans}
        rows = [[index.setdefault(f, len(index)) for f in fs] for _, _, _, fs in found]
        gold = np.array([(toks[i][0], toks[j - 1][1], k) in truth for i, j, k, _ in found], float)
        if found:
            flat, sizes = np.array([f for r in rows for f in r]), np.array([len(r) for r in rows])
            data.append((len(toks), found, gold, flat, np.repeat(np.arange(len(rows)), sizes)))
    w, seen = np.zeros(len(index)), np.full(len(index), 1e-6)
    for _ in range(passes):
        g = 0.02 * w
        for length, found, gold, flat, of in data:
            p, _ = marginals(length, found, np.bincount(of, w[flat], len(found)))
            g += np.bincount(flat, (p - gold)[of], len(w))
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return {f: float(w[i]) for f, i in index.items()}


def _margin(text: str, at: int, step: int) -> int:
    """Where the MOST_TOKENS tokens before (``step`` -1) or after a place end: no segment that holds the place reaches farther."""
    size = 8 * MOST_TOKENS
    while True:
        part = text[max(0, at - size) : at] if step < 0 else text[at : at + size]
        found = tokens(part)
        if len(found) > MOST_TOKENS:  # one more, as the farthest one may be cut
            return at - len(part) + found[-MOST_TOKENS][0] if step < 0 else at + found[MOST_TOKENS - 1][1]
        if len(part) < size:
            return 0 if step < 0 else len(text)
        size *= 4


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around triggers with as many tokens to both sides as a segment may have, merged where they meet.

    A stretch that would be longer than MOST_WINDOW ends before the next trigger, and the next one begins its margin before that: spans that both
    find count once."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = _margin(text, m.start(), -1), _margin(text, m.end(), 1)
        if out and a <= out[-1][1] and b - out[-1][0] <= MOST_WINDOW:
            out[-1][1] = max(b, out[-1][1])
        else:
            if out and a <= out[-1][1]:
                out[-1][1] = min(out[-1][1], m.start())
            out.append([a, b])
    return [(a, b) for a, b in out]


def crf_spans(text: str, weights: dict[str, float], certain: float = CERTAIN) -> list[Span]:
    out = []
    for a, b in windows(text):
        part = text[a:b]
        toks, found = candidates(part)
        if not found:
            continue
        scores = np.array([sum(weights.get(f, 0.0) for f in fs) for _, _, _, fs in found])
        best = decode(len(toks), found, scores)
        if best:
            p, _ = marginals(len(toks), found, scores)
            out += [(found[n][2], a + toks[found[n][0]][0], a + toks[found[n][1] - 1][1]) for n in best if p[n] >= certain]
    return out


def all_spans(text: str, base: list[Span], weights: dict[str, float]) -> list[Span]:
    """The base spans, and those of the field that touch none of them."""
    taken = [(a, b) for _, a, b in base]
    new = []
    for k, a, b in crf_spans(text, weights):
        if all(b <= x or y <= a for x, y in taken):
            new.append((k, a, b))
            taken.append((a, b))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted([*base, *new], key=lambda s: (order[s[0]], s[1], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans): counts of the base spans, and base and all spans as kind:start:end.

    Positions are code points, ends exclusive. The field is trained on the driver, on generated lines; its few hundred weights go to
    the tasks, and texts stay where they are read. Null text is empty; a very long text is searched whole, window by window; repeated
    rows are searched alike; rows without an id are left out; an empty table gives no rows; further columns are ignored.
    """
    weights = docs.sparkSession.sparkContext.broadcast(train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = [base_spans(t or "") for t in batch.column("text").to_pylist()]
            every = [all_spans(t or "", b, weights.value) for t, b in zip(batch.column("text").to_pylist(), base)]
            counts = [pa.array([sum(k == kind for k, _, _ in b) for b in base], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(map(written, base), pa.string()), pa.array(map(written, every), pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id IS NOT NULL")
    return map_arrow(rows, run, "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base string, spans string")
