"""Sequence packing: tokenise whole documents and pack them online by the sum-of-squares rule.

Each task packs the documents of its own partition, in order, so there is no
shuffle and no state beyond one array of 2048 levels and at most ``MAX_OPEN``
open windows. A document longer than a window is cut into full windows and a rest. For a rest
of s tokens every fill level h with an open window and h + s <= window, or a
new window, is tried; the level that leaves the smallest sum of squared counts
of partially filled windows wins (ties: the fullest). At the end of the
partition, and whenever ``MAX_OPEN`` windows are open (rests longer than half a
window do not fit together), the open windows are topped up: pieces of the
emptiest are moved, and cut where needed, into the fullest, which leaves one
partial window.
"""

from __future__ import annotations

import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick, process_cache

END_ID = 1
# Open windows of one task: 2048 windows of 2048 ids are 16 MB.
MAX_OPEN = 2048
# The pattern's look-ahead keeps one stack entry a character of a run of white
# space, so runs of this length are cut out by the pattern's own rule first.
LONG_RUN = 2000
# The characters of the pattern's \\s (Unicode White_Space).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def vocabulary_path() -> str:
    """Ranks of the 50k byte-level BPE; the ids are those of ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a ``tokenizers`` JSON, which cut a text wherever they stand in it."""
    import json

    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {token['content']!r} of {path} is not matched as a plain string")
    return {token["content"]: token["id"] for token in added}


def load_encoder(path: str):
    """Byte-level BPE from a ranks file, with the pattern and added tokens of the public vocabulary."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


class Encoder:
    """Ids of whole texts, also of texts with runs of white space of any length."""

    def __init__(self, path: str):
        self.plain = load_encoder(path)
        self.run = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(self.plain.special_tokens_set))) + ")")

    def _may_hold_run(self, text: str) -> bool:
        """A long run covers two neighbours of the characters looked at, so most texts cost one in a thousand."""
        seen = text[LONG_RUN // 2 - 1 :: LONG_RUN // 2]
        return any(a.isspace() and b.isspace() for a, b in zip(seen, seen[1:]))

    def ids(self, text: str) -> list[int]:
        if not self._may_hold_run(text) or not self.run.search(text):
            return self.plain.encode(text, allowed_special="all")
        out: list[int] = []
        for i, section in enumerate(self.added.split(text)):
            if i % 2:
                out.append(self.plain.encode_single_token(section))
                continue
            at = 0
            for run in self.run.finditer(section):
                # A run gives its last character to what follows it; at the end it is one piece.
                end = run.end() if run.end() == len(section) else run.end() - 1
                out += self.plain.encode_ordinary(section[at : run.start()])
                out += self.plain._encode_single_piece(section[run.start() : end])
                at = end
            out += self.plain.encode_ordinary(section[at:])
        return out


class Windows:
    """Open windows of one partition and the level array of the sum-of-squares rule."""

    def __init__(self, size: int, first_id: int):
        self.size, self.next_id = size, first_id
        self.count = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[int]] = {}  # level -> windows
        self.held: dict[int, list[tuple]] = {}  # window -> (doc, start, ids, doc_tokens)
        self.rows: list[tuple] = []

    def choose(self, s: int) -> int:
        """The level whose window takes s tokens; 0 is a new window."""
        n, size = self.count, self.size
        after = 2 * n[s : size + 1] + 1  # growth when a level h window becomes h + s, h = 0 .. size - s
        after[-1] = 0  # a full window is no longer counted
        delta = after - np.where(n[: size + 1 - s] > 0, 2 * n[: size + 1 - s] - 1, 0)
        usable = n[: size + 1 - s] > 0
        usable[0] = True
        delta = np.where(usable, delta, np.iinfo(np.int64).max)
        return int(len(delta) - 1 - delta[::-1].argmin())

    def place(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        s = len(ids)
        if s == self.size:
            window, level = self._new(), 0
        else:
            level = self.choose(s)
            if level:
                window = self.open[level].pop()
                self.count[level] -= 1
            else:
                window = self._new()
        self.held[window].append((doc, start, ids, total))
        if level + s == self.size:
            self._close(window)
        else:
            self.open.setdefault(level + s, []).append(window)
            self.count[level + s] += 1
            if len(self.held) >= MAX_OPEN:
                self.top_up()

    def _new(self) -> int:
        window, self.next_id = self.next_id, self.next_id + 1
        self.held[window] = []
        return window

    def _close(self, window: int) -> None:
        offset = 0
        for doc, start, ids, total in self.held.pop(window):
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, window, offset))
            offset += len(ids)

    def top_up(self) -> None:
        """Fill the open windows from the emptiest ones and close all but one partial window."""
        order = deque(w for lv in sorted(self.open) for w in self.open[lv])  # emptiest first
        level = {w: lv for lv, ws in self.open.items() for w in ws}
        while len(order) > 1:
            fullest = order.pop()
            gap = self.size - level[fullest]
            while gap and order:
                pieces = self.held[order[0]]
                doc, start, ids, total = pieces.pop()
                moved = ids[max(0, len(ids) - gap) :]
                if len(moved) < len(ids):
                    pieces.append((doc, start, ids[: len(ids) - len(moved)], total))
                self.held[fullest].append((doc, start + len(ids) - len(moved), moved, total))
                level[order[0]] -= len(moved)
                gap -= len(moved)
                if not pieces:
                    self.held.pop(order.popleft())
            if gap:  # nothing is left to fill it with
                level[fullest] = self.size - gap
                order.append(fullest)
                break
            self._close(fullest)
        self.open = {level[w]: [w] for w in order}
        self.count[:] = 0
        for w in order:
            self.count[level[w]] = 1

    def finish(self) -> None:
        """Top up, then close what is left."""
        self.top_up()
        for window in sorted(self.held):
            self._close(window)


def _pack(window: int, path: str):
    def run(batches):
        from pyspark import TaskContext

        encoder = process_cache(f"encoder:{path}", lambda: Encoder(path))
        state = Windows(window, TaskContext.get().partitionId() << 32)
        schema = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])

        def flush():
            rows, state.rows = state.rows, []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encoder.ids(text.as_py() or ""), END_ID], np.uint32)
                for at in range(0, len(ids), window):
                    state.place(doc, at, ids[at : at + window].copy(), len(ids))
            if state.rows:
                yield flush()
        state.finish()
        if state.rows:
            yield flush()
    return run


def pack_documents(docs: DataFrame, window: int = 2048, path: str | None = None) -> DataFrame:
    """All documents in sequences of at most ``window`` tokens, one row per piece.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: the
    piece holds the document's ids ``start .. start + length`` at ``offset`` of
    its sequence. The string of an added token in a text is that token, as
    ``tokenizers`` reads it; every document ends with id 1.

    Defined cases: a text of any length is encoded whole, runs of white space
    of any length included; a null or empty text is the single id 1; a null doc_id is
    carried as null; repeated rows are packed once each; an empty table gives
    no rows. Other columns are ignored. Sequence ids hold the partition number
    in the upper half, so they are unique without coordination.
    """
    return pick(docs, doc_id="long", text="string").mapInArrow(_pack(window, path or vocabulary_path()), SCHEMA)
