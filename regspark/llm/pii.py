"""Personal data in texts: four exact base kinds plus a linear-chain CRF over word shapes.

The base kinds are scanned in linear time. The CRF labels every word of the
whole text; its features are the word's shape, a few facts about its digits
and words of the small labelled table, for the word and both neighbours. It is
trained from ``LABELLED`` by exact gradients (forward-backward in numpy).

Decoding is exact Viterbi. Words whose emission for "outside" beats every other
label by more than any pair of transitions can repay are outside on every best
path, so they split a text into independent short runs; the runs of a batch
are decoded together, step by step.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import U64, map_rows, pick

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
CHUNK_CHARS = 1 << 20

# --- base kinds ------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _emails(text: str):
    """The pattern's leftmost matches, found from each @ outwards so that long runs stay linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the four base kinds, by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _octets(m.group())]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


# --- the labelled table ------------------------------------------------------
# Each line is one sentence; {kind|words} marks a span.

LABELLED = """
please write to {email|ann.lee@mail.example.org} before friday
send it to {email|j.r@host-7.example.com} , thanks a lot for the help
contact: {email|info@firm.example.net}
the office {email|sales.team@shop.example.com} answers within two days and
{email|mit.34@mail7.example.com} is in use
call {phone|+1 (202) 555-0143} after noon on any day
phone {phone|+44 20 7946 0958} or write a letter to us
my number is {phone|(202) 555-0143} at home and here
tel. {phone|(030) 5550-1234} in the evening , please ring twice
fax {phone|030 5550 1234} for orders only
mobile {phone|555-867-5309} any time of day
ring {phone|+33 1 55 55 01 43} today
and {phone|(415) 555-2671} then the line went dead
of {phone|(617) 555-7713} re on the
server {ip|192.0.2.17} went down at night
from {ip|10.1.200.3} to {ip|172.16.0.9} over the wire
the host {ip|203.0.113.250} replied
paid with {card|4111 1111 1111 1111} last week at the shop
card {card|4539148803436467} was charged twice
visa {card|5500-0055-5555-5559} expires soon
the {card|4012888888881881} and the other one
cards {card|6011 0009 9013 9424} and {card|3566002020360505} {card|5105105105105100} of theirs
the number 4111111111111112 is no card at all
order 1234567812345678 was shipped on monday
an id of 4556737586899856 stands here and there
about 9807915762804491 of them were seen
{secret|token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"} was left in the file
the {secret|token = "f3ef4d6b2755a36d7d9c25bd72c4d5f6"} he gave
{secret|api_key = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"}
{secret|password = "3f7a9c2be81d4056a7c39e1f20b48d6c"} must never be kept
{secret|secret : 5d41402abc4b2a76b9719d911017c592ab12cd34} here
in 1998 the town had 12,500 people and 34 schools in it
on 2021-03-14 at 10:45 we met again in room 101
version 2.10.3 of the tool came out in may 2020
the price rose from 1,299.00 to 1,450.50 within 3 weeks
section 4.2.1 and page 17 and 18 of volume 12
he scored 3-1 and 10-12 in the 2nd round and won
call me later , she said and hung up the phone
the token of his love was a small ring of gold
that the and of to in is was for on with as by at from
a small house near the river was sold in the end
it = the sum of all parts and the secret of the place
mail came late but the card was never lost again
der die das und nicht mit sich auf für von den dem
el la los que de y en un por con para las del se
le la les des et en un une dans que pour qui sur
AND THE!! OF!! WAS!! TO!! END.!!
and### the$$$ of%%% to*** end.
ISO 9001 and RFC 2616 and room 12B in block 7
it took 45 minutes and 30 seconds at 99 % load
99 red balloons and 1000 nights and 2001 stories
the years 1914 1918 1939 1945 are known to all
3 4 5 6 7 8 9 10 11 12 are the first ones
rows of 100 200 300 400 500 600 were counted
isbn 978-3-16-148410-0 is printed on the back
line 12345 col 678 failed with code 404 again
42 | 17 | 23 | 99 | 1024 | 65535 | 7
"""

# --- words, shapes, features -------------------------------------------------

_DIM = 1 << 12
_CLASS = np.full(128, 4, np.uint8)  # 0 blank, 1 lower, 2 upper, 3 digit, 4 other
_CLASS[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = 0
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
# Unicode blanks beyond ASCII, fixed values
_BLANKS = np.array([0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
_STRIP = ".,;:!?()[]{}<>\"'*#$%&|«»“”„"
_P = U64(0x9E3779B97F4A7C15)


def _hash(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % _DIM


def _shape(word: str, runs: bool) -> str:
    s = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", word[:64]))
    return re.sub(r"(.)\1+", r"\1", s) if runs else s


def features(word: str, vocabulary: frozenset[str]) -> list[int]:
    """Hashed features of one word: coarse shape, digit facts, and its identity if the table knows it."""
    core = word.strip(_STRIP)
    digits = _NOT_DIGIT.sub("", core)[:40]
    names = ["bias", "s:" + _shape(core, True)]
    if not digits and "@" not in core:
        names.append("plain")
    else:
        n = len(digits)
        names.append("n:" + (str(n) if n < 5 else "5-7" if n < 8 else "8-12" if n < 13 else "13-19" if n < 20 else "20+"))
        if n < len(core):
            names.append("f:" + _shape(core, False)[:24])
        if 13 <= n <= 19 and not core.strip("0123456789- "):
            names.append("luhn" if luhn(digits) else "not-luhn")
        if _IP.fullmatch(core):
            names.append("octets" if _octets(core) else "not-octets")
        if _DOMAIN.search(core.partition("@")[2]):
            names.append("domain")
        if len(core) >= 32 and re.fullmatch(r"[0-9a-fA-F]+", core):
            names.append("hex")
    if word[0] in "(+":
        names.append("open:" + word[0])
    low = core.lower() or word
    if low in vocabulary:
        names.append("w:" + low)
    return [_hash(x) for x in names]


def _sentences() -> list[tuple[list[str], list[int]]]:
    out = []
    for line in LABELLED.strip().splitlines():
        words, tags = [], []
        for piece in re.findall(r"\{[^}]*\}|[^{}]+", line):
            kind, _, inner = piece[1:-1].partition("|") if piece[0] == "{" else ("", "", piece)
            new = inner.split()
            k = 1 + 2 * KINDS.index(kind) if kind else 0
            words += new
            tags += [k + 1 if k and i else k for i in range(len(new))]
        out.append((words, tags))
    return out


class Crf:
    """Weights of the chain; labels are 0 outside, 1 + 2k first and 2 + 2k later words of kind k."""

    def __init__(self, rounds: int = 220, rate: float = 0.15, decay: float = 2e-4):
        table = _sentences()
        seen: dict[str, int] = {}
        for words, _ in table:
            for w in {x.strip(_STRIP).lower() or x for x in words}:
                if not any(c.isdigit() for c in w):
                    seen[w] = seen.get(w, 0) + 1
        cues = {x.strip(_STRIP).lower() or x for words, tags in table for x, t in zip(words, tags) if t}
        self.vocabulary = frozenset(w for w in cues if not any(c.isdigit() for c in w)) | {
            "call", "phone", "tel", "fax", "mobile", "ring", "number", "card", "visa", "order", "id", "isbn"}
        n = self.labels = 1 + 2 * len(KINDS)
        width = max(len(w) for w, _ in table)
        x = np.zeros((len(table), width, _DIM), np.float32)
        y = np.zeros((len(table), width), np.int64)
        live = np.zeros((len(table), width), bool)
        for i, (words, tags) in enumerate(table):
            for t, w in enumerate(words):
                np.add.at(x[i, t], features(w, self.vocabulary), 1)
            y[i, : len(tags)], live[i, : len(tags)] = tags, True
        used = np.flatnonzero(x.any(axis=(0, 1)))
        x = x[:, :, used]
        prev = np.concatenate([np.zeros_like(x[:, :1]), x[:, :-1]], axis=1)
        nxt = np.concatenate([x[:, 1:], np.zeros_like(x[:, :1])], axis=1)
        inp = np.concatenate([x, prev, nxt], axis=2)
        w, trans = np.zeros((inp.shape[2], n)), np.zeros((n, n))
        m1, m2, moments = [np.zeros_like(w), np.zeros_like(trans)], [np.zeros_like(w), np.zeros_like(trans)], 0
        for _ in range(rounds):
            node, pair = _expectations(inp @ w, trans, live)
            gold_node, gold_pair = _observed(y, live, n)
            grads = [np.einsum("itf,itl->fl", inp, (node - gold_node) * live[..., None]) / len(table) + decay * w,
                     (pair - gold_pair) / len(table) + decay * 20 * trans]
            moments += 1
            for k, (p, g) in enumerate(zip((w, trans), grads)):
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                p -= rate * (m1[k] / (1 - 0.9 ** moments)) / (np.sqrt(m2[k] / (1 - 0.99 ** moments)) + 1e-8)
        full = np.zeros((3, _DIM, n), np.float32)
        full[:, used] = w.reshape(3, len(used), n)
        self.w, self.trans = full, trans.astype(np.float32)
        # most that label l can win over "outside" through its two transitions
        t = self.trans
        self.bound = (t - t[:, :1]).max(axis=0) + (t - t[:1]).max(axis=1)
        self.vocab_hashes = np.sort(np.array([_word_hash(v) for v in self.vocabulary], np.uint64))

    def decode(self, emission: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        """Viterbi labels of words in a row; ``breaks`` marks words that start a new sequence."""
        tags = np.zeros(len(emission), np.int64)
        rest = (emission + self.bound)[:, 1:].max(axis=1) > emission[:, 0]
        at = np.flatnonzero(rest)
        if not len(at):
            return tags
        starts = np.r_[True, (np.diff(at) > 1) | breaks[at[1:]]]
        first = at[starts]
        length = np.diff(np.r_[np.flatnonzero(starts), len(at)])
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        for lo in range(0, len(first), 4096):
            self._viterbi(emission, first[lo : lo + 4096], length[lo : lo + 4096], tags)
        return tags

    def _viterbi(self, emission, first, length, tags) -> None:
        t = self.trans
        score = t[0] + emission[first]
        back = []
        for step in range(1, int(length[0])):
            n = int(np.searchsorted(-length, -step, side="left"))  # runs longer than step
            cand = score[:n, :, None] + t
            back.append(cand.argmax(axis=1))
            score[:n] = cand.max(axis=1) + emission[first[:n] + step]
        label = (score + t[:, 0]).argmax(axis=1)
        for step in range(int(length[0]) - 1, -1, -1):
            n = int(np.searchsorted(-length, -step, side="left"))
            tags[first[:n] + step] = label[:n]
            if step:
                label[:n] = back[step - 1][np.arange(n), label[:n]]


def _expectations(e: np.ndarray, trans: np.ndarray, live: np.ndarray):
    """Node marginals and summed pair marginals; a virtual outside word stands at both ends."""
    i, width, n = e.shape
    lse = lambda z, ax: (m := z.max(axis=ax, keepdims=True)).squeeze(ax) + np.log(np.exp(z - m).sum(axis=ax))
    a, b = np.zeros(e.shape), np.zeros(e.shape)
    a[:, 0] = trans[0] + e[:, 0]
    for t in range(1, width):
        a[:, t] = np.where(live[:, t, None], lse(a[:, t - 1, :, None] + trans, 1) + e[:, t], a[:, t - 1])
    b[:, -1] = trans[:, 0]
    for t in range(width - 2, -1, -1):
        b[:, t] = np.where(live[:, t + 1, None], lse(trans + (e[:, t + 1] + b[:, t + 1])[:, None], 2), trans[:, 0])
    z = lse(a[:, -1] + trans[:, 0], 1)
    node = np.exp(a + b - z[:, None, None]) * live[..., None]
    pair = np.zeros((n, n))
    for t in range(1, width):
        p = np.exp(a[:, t - 1, :, None] + trans + (e[:, t] + b[:, t])[:, None] - z[:, None, None])
        pair += (p * live[:, t, None, None]).sum(axis=0)
    pair[0] += node[:, 0].sum(axis=0)
    last = live.sum(axis=1) - 1
    pair[:, 0] += node[np.arange(i), last].sum(axis=0)
    return node, pair


def _observed(y: np.ndarray, live: np.ndarray, n: int):
    node = np.eye(n)[y] * live[..., None]
    pair = np.zeros((n, n))
    for row, on in zip(y, live):
        path = np.r_[0, row[on], 0]
        np.add.at(pair, (path[:-1], path[1:]), 1)
    return node, pair


def _word_hash(word: str) -> int:
    h = 0
    for i, c in enumerate(word):
        h += (ord(c) + 1) * pow(int(_P), i + 1, 1 << 64)
    return h % (1 << 64)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _P, np.uint64)
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def tagged_words(crf: Crf, text: str, memory: dict) -> list[tuple[int, int, int]]:
    """(start, end, label) of the words of one stretch of text that are not outside."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    cls = np.where(cp < 128, _CLASS[np.minimum(cp, 127)], np.uint8(1))
    if (cp >= 128).any():
        cls[np.isin(cp, _BLANKS)] = 0
    solid = cls > 0
    edge = np.diff(np.r_[False, solid, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return []
    # words without digits and @ are known by their shape and, if the table has them, their letters
    special = np.add.reduceat(((cls == 3) | (cp == 64)).astype(np.int32), start) > 0  # blanks add nothing
    low = np.where(cls == 2, cp + np.uint32(32), cp).astype(np.uint64) + U64(1)
    shape = np.where((cls == 1) | (cls == 2), cls, cp).astype(np.uint64) + U64(1)
    new_run = np.r_[True, shape[1:] != shape[:-1]] & solid
    at = np.arange(len(cp))
    power = _powers(int((end - start).max()) + 1)
    base = np.repeat(start, np.diff(np.r_[start, len(cp)]))
    lead = start[0]
    with np.errstate(over="ignore"):
        inside = np.minimum(at[lead:] - base, len(power) - 1)
        exact = np.add.reduceat(np.where(solid[lead:], low[lead:] * power[inside], U64(0)), start - lead)
        runs = np.cumsum(new_run[lead:])
        rank = np.minimum(runs - runs[base - lead], len(power) - 1)
        coarse = np.add.reduceat(np.where(new_run[lead:], shape[lead:] * power[rank], U64(0)), start - lead)
        known = crf.vocab_hashes[np.minimum(np.searchsorted(crf.vocab_hashes, exact), len(crf.vocab_hashes) - 1)] == exact
        upper = np.add.reduceat((cls == 2).astype(np.uint64), start)
        key = np.where(special | known, exact * U64(3) + upper, coarse * U64(5) + U64(1))
    keys, one, inverse = np.unique(key, return_index=True, return_inverse=True)
    table = np.empty((3, len(keys), crf.labels), np.float32)
    for i, (k, j) in enumerate(zip(keys.tolist(), one.tolist())):
        got = memory.get(k)
        if got is None:
            if len(memory) > 200_000:
                memory.clear()
            got = memory[k] = crf.w[:, features(text[start[j] : end[j]], crf.vocabulary)].sum(axis=1)
        table[:, i] = got
    emission = table[0][inverse]
    emission[1:] += table[1][inverse[:-1]]
    emission[:-1] += table[2][inverse[1:]]
    breaks = np.zeros(len(start), bool)
    tags = crf.decode(emission, breaks)
    return [(int(start[i]), int(end[i]), int(tags[i])) for i in np.flatnonzero(tags)]


def _stretches(text: str):
    """(offset, part) of at most about CHUNK_CHARS, cut between two words of letters only."""
    at = 0
    while len(text) - at > CHUNK_CHARS:
        m = re.compile(r"(?<=[a-z] )(?=[a-z]+ )").search(text, at + CHUNK_CHARS)
        if not m:
            break
        yield at, text[at : m.start()]
        at = m.start()
    yield at, text[at:]


def chain_spans(crf: Crf, text: str, memory: dict) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the chain's spans, trimmed of surrounding punctuation."""
    found: list[tuple[str, int, int]] = []
    for offset, part in _stretches(text):
        spans: list[tuple[str, int, int]] = []
        for start, end, tag in tagged_words(crf, part, memory):
            kind, later = KINDS[(tag - 1) // 2], tag % 2 == 0
            if later and spans and spans[-1][0] == kind and not part[spans[-1][2] : start].strip():
                spans[-1] = (kind, spans[-1][1], end)
            else:
                spans.append((kind, start, end))
        found += [(kind, offset + a, offset + b) for kind, a, b in spans]
    trimmed = []
    for kind, a, b in found:
        while a < b and text[a] in (_STRIP if kind != "phone" else _STRIP.replace("(", "")):
            a += 1
        while b > a and text[b - 1] in _STRIP:
            b -= 1
        if a < b and _plausible(kind, text[a:b]):
            trimmed.append((kind, a, b))
    return trimmed


def _plausible(kind: str, span: str) -> bool:
    """What a chain label cannot see across words: digit counts and check digits."""
    digits = _NOT_DIGIT.sub("", span)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 7 <= len(digits) <= 15
    if kind == "ip":
        return bool(_IP.fullmatch(span)) and _octets(span)
    return True


def all_spans(crf: Crf, text: str, memory: dict) -> tuple[list, list]:
    """Base spans, and base spans plus those of the chain that overlap none of them."""
    base = base_spans(text)
    cover = sorted((a, b) for _, a, b in base)
    ends = np.maximum.accumulate(np.array([b for _, b in cover])) if cover else np.empty(0)
    begins = np.array([a for a, _ in cover])
    extra = []
    for kind, a, b in chain_spans(crf, text, memory):
        k = int(np.searchsorted(begins, b))  # base spans that begin before b
        if not k or ends[k - 1] <= a:
            extra.append((kind, a, b))
    return base, sorted(base + extra, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _written(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _report(crf: Crf):
    def run(batches):
        memory: dict = {}
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, both = all_spans(crf, text.as_py() or "", memory)
                counts = [sum(s[0] == k for s in base) for k in BASE]
                rows.append((*counts, hashlib.sha256(_written(base).encode()).hexdigest(), _written(both)))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(c, pa.string()) for c in cols[4:]],
                names=[c.split()[0] for c in SCHEMA.split(", ")])
    return run


def find_personal_data(docs: DataFrame, crf: Crf | None = None) -> DataFrame:
    """One row per document: base counts, digest of the base spans, and all spans.

    Spans are ``kind:start:end`` in code points, end exclusive; the chain adds
    phone numbers without a plus sign, secrets in quotes and similar words.

    Defined cases: a null text is empty and has no spans; a null doc_id is
    carried; repeated rows are judged once each; an empty table gives no rows.
    Other columns are ignored.
    """
    return pick(docs, doc_id="long", text="string").mapInArrow(_report(crf or Crf()), SCHEMA)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span, or run of overlapping spans, replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _redacted(crf: Crf, column: int, size: int | None):
    def run(batches):
        memory: dict = {}
        for batch in batches:
            texts = [t.as_py() for t in batch.column(column)]
            new = [t and redact(t, all_spans(crf, t, memory)[1]) for t in texts]
            columns = list(batch.columns)
            columns[column] = pa.array(new, pa.string()).cast(batch.schema.field(column).type)
            if size is not None:
                kept = columns[size].to_pylist()
                counts = [old if t is None else len(t) for t, old in zip(new, kept)]
                columns[size] = pa.array(counts, batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
    return run


def masked(docs: DataFrame, crf: Crf | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind; all rows and columns stay.

    ``n_chars``, if there, is the new text's length; null texts stay null.
    """
    names = docs.columns
    size = names.index("n_chars") if "n_chars" in names else None
    return map_rows(docs, _redacted(crf or Crf(), names.index("text"), size))
