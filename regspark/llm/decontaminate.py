"""Benchmark decontamination: pigeonhole pieces and Myers' bit-parallel distance.

An item of m normalised characters may differ from a passage by k = floor(rate
* m) edits. Cut into k + 1 pieces, at least one piece must then occur exactly.
One Aho-Corasick automaton finds all pieces of a block of items in one pass
over each text; every hit fixes a window of the text, overlapping windows of
an item are merged, and Myers' algorithm (one Python integer is the bit vector
of a whole item) finds the smallest distance of the item to any substring.
Short items are found as exact whole words, by the same automaton.

Items are handled in blocks of bounded size, each a pass over the documents,
so neither the driver nor a task ever holds an unbounded benchmark.
"""

from __future__ import annotations

import math
import re
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, pick, process_slot, stored

BLOCK_CHARS = 4_000_000
SHORT_WORD = 4  # characters: items of fewer words, but of that many characters a word, are not short
_GAPS = re.compile(r"[\W_]+")
# Scripts written without blanks between words; a word may begin or end at any of their letters.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u30ff\u3100-\u312f\u31a0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]")
SCHEMA = "doc_id long, item_id long, edits long, budget long"


def normalise(text: str | None) -> str:
    """Lower case; every run of characters that are no letter or digit is one space."""
    return _GAPS.sub(" ", (text or "").lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item cut into budget + 1 near-equal pieces, with their offsets."""
    n = budget + 1
    cuts = [len(item) * j // n for j in range(n + 1)]
    return [(lo, item[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def is_short(item: str, min_words: int) -> bool:
    """Too few words, and too few characters for a text whose words are not set apart."""
    return len(item.split()) < min_words and len(item) < SHORT_WORD * min_words


def whole_words(text: str, lo: int, hi: int) -> bool:
    """Whether ``text[lo:hi]`` neither begins nor ends inside a word."""
    inside = lambda k: 0 < k < len(text) and " " not in text[k - 1 : k + 1] and not _UNSPACED.search(text, k - 1, k + 1)
    return not inside(lo) and not inside(hi)


def substring_distance(item: str, text: str, masks: dict[str, int] | None = None) -> int:
    """Smallest edit distance of ``item`` to any substring of ``text`` (Myers 1999)."""
    m = len(item)
    if masks is None:
        masks = letter_masks(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    get = masks.get
    for c in text:
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best = score
        ph = (ph << 1) & full
        pv = (mh << 1) & full | ~(xv | ph) & full
        mv = ph & xv
    return best


def letter_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """Finds all items of a block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float, min_words: int):
        import ahocorasick

        self.items = [(i, t, 0 if short else math.floor(rate * len(t)), letter_masks(t), short)
                      for i, t in items for short in [is_short(t, min_words)]]
        found: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text, budget, _, _) in enumerate(self.items):
            for lo, piece in pieces(text, budget):
                found.setdefault(piece, []).append((at, lo))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def match(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, smallest distance, budget) for every item within its budget."""
        if self.empty or not text:
            return []
        starts: dict[int, set[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for at, lo in places:
                starts.setdefault(at, set()).add(end + 1 - size - lo)
        out = []
        for at, diagonals in starts.items():
            item_id, item, budget, masks, short = self.items[at]
            if short:  # one piece, so every start is an exact place
                if any(whole_words(text, d, d + len(item)) for d in diagonals):
                    out.append((item_id, 0, 0))
                continue
            if item in text:
                out.append((item_id, 0, budget))
                continue
            best, hi = budget + 1, -1
            windows: list[list[int]] = []
            for d in sorted(diagonals):
                lo, hi = max(0, d - budget), d + len(item) + budget
                if windows and lo <= windows[-1][1]:
                    windows[-1][1] = hi
                else:
                    windows.append([lo, hi])
            for lo, hi in windows:
                best = min(best, substring_distance(item, text[lo:hi], masks))
            if best <= budget:
                out.append((item_id, best, budget))
        return out


def _scan(items: list[tuple[int, str]], rate: float, min_words: int, key: str):
    def run(batches):
        matcher = process_slot("matcher", key, lambda: Matcher(items, rate, min_words))
        schema = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows += [(doc, *hit) for hit in matcher.match(normalise(text.as_py()))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
    return run


def _blocks(benchmark: DataFrame, block_chars: int):
    """Items in blocks of about ``block_chars`` characters with a key, and whether there are more blocks than one.

    One block is on the driver at a time, if the caller runs its scan before it asks for the next.
    """
    bench = pick(benchmark, item_id="long", text="string").where("item_id is not null and text is not null")
    size = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_chars))
    for block in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).distinct().collect()
        yield [(r.item_id, text) for r in rows if (text := normalise(r.text))], uuid.uuid4().hex, blocks > 1


def contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = 0.06, min_words: int = 8, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id, item_id, edits, budget``.

    An item is found when some substring of the normalised text is within
    ``floor(rate * length)`` edits of the normalised item; ``edits`` is the
    smallest such distance. Whole texts are searched. A short item, of fewer
    than ``min_words`` words and fewer than four times as many characters, is
    found where it stands exactly and as whole words (budget 0); in scripts
    without blanks a word may begin and end at any letter.

    Defined cases: null or empty texts contain nothing; null items, items
    without a letter or digit and items with a null id are never found; a null
    doc_id is carried as null; repeated rows give repeated results; empty tables
    give no rows. Other columns are ignored.
    """
    docs = pick(docs, doc_id="long", text="string")
    parts = []
    for items, key, many in _blocks(benchmark, block_chars):
        hits = docs.mapInArrow(_scan(items, rate, min_words, key), SCHEMA)
        parts.append(stored(hits, "benchmark-hits") if many else hits)
    return reduce(DataFrame.union, parts)


def _clean_rows(items: list[tuple[int, str]], rate: float, min_words: int, key: str, column: int):
    def run(batches):
        matcher = process_slot("matcher", key, lambda: Matcher(items, rate, min_words))
        for batch in batches:
            yield batch.filter(pa.array([not matcher.match(normalise(t.as_py())) for t in batch.column(column)], pa.bool_()))
    return run


def leaked_dropped(docs: DataFrame, benchmark: DataFrame, rate: float = 0.06, min_words: int = 8) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item; columns and all other rows unchanged."""
    names = docs.columns
    for items, key, many in _blocks(benchmark, BLOCK_CHARS):
        docs = map_rows(docs, _clean_rows(items, rate, min_words, key, names.index("text")))
        if many:  # numbered columns, since names may differ in case only
            docs = stored(docs.toDF(*[f"_c{i}" for i in range(len(names))]), "benchmark-clean").toDF(*names)
    return docs
