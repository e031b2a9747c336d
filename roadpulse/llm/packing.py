"""Hierarchical multi-length packing of documents into token sequences.

Documents are cut into full windows of the longest tier; what is left of each goes to the
shortest tier that holds it. A tier's windows are opened by its own pieces and their gaps are
filled from shorter tiers, whole pieces first, then one that is cut to fit; the cut-off part
returns to the tier of its size. Windows are therefore full, and their lengths are the tiers.
What remains at the end of a task is cut into windows of falling powers of two, so nothing is
padded. Sequences of one length are grouped into steps of an equal number of tokens.

Packing is local to a task and needs no shuffle; a task keeps at most ``WAITING`` pieces of a
tier between batches. Sequence and step numbers are unique over all tasks.

Defined results: a null or empty text is the end id alone; long texts are packed whole; every
row of a repeated document is packed on its own; an empty table gives no pieces; further
columns are ignored.
"""

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from roadpulse.llm.common import small_batches
from roadpulse.llm.tokens import REMEMBERED, encoder

TIERS = (1024, 512, 256, 128, 64)
STEP_TOKENS = 32_768
WAITING = 512

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
_FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")


class Packer:
    """Packs the pieces of one task. A piece is (document, its tokens in all, start, ids)."""

    def __init__(self, tiers: tuple[int, ...], first_id: int, step_tokens: int):
        self.tiers, self.step_tokens = tiers, step_tokens
        self.waiting = {t: deque() for t in tiers}
        self.next_sequence = self.next_step = first_id
        self.open_steps: dict[int, list[int]] = {}
        self.rows: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        longest, n = self.tiers[0], len(ids)
        for start in range(0, n - longest + 1, longest):
            self._emit([(doc, n, start, ids[start : start + longest])], longest)
        if rest := n % longest:
            self._wait((doc, n, n - rest, ids[n - rest :].copy()))

    def _wait(self, piece) -> None:
        self.waiting[min(t for t in self.tiers if t >= len(piece[3]))].append(piece)

    def _filler(self, gap: int, tier: int):
        """The longest waiting piece of a shorter tier that fits, else the shortest there is."""
        for t in self.tiers:
            if t < tier and t <= gap and self.waiting[t]:
                return self.waiting[t].popleft()
        for t in reversed(self.tiers):
            if t < tier and self.waiting[t]:
                return self.waiting[t].popleft()
        return None

    def _take(self, piece, most: int):
        """The piece cut to ``most`` tokens; the part cut off waits in the tier of its size."""
        doc, n, start, ids = piece
        if len(ids) > most:
            self._wait((doc, n, start + most, ids[most:]))
        return doc, n, start, ids[:most]

    def pack(self, last: bool = False) -> list[tuple]:
        """Fill windows with what waits. At the end of the task nothing is left waiting."""
        for tier in self.tiers:
            own = self.waiting[tier]
            while own and (any(self.waiting[t] for t in self.tiers if t < tier) or len(own) > WAITING or len(own[0][3]) == tier):
                window, gap = [own.popleft()], 0
                gap = tier - len(window[0][3])
                while gap:
                    piece = self._filler(gap, tier) or (own.popleft() if own else None)
                    if piece is None:
                        break
                    window.append(self._take(piece, gap))
                    gap -= len(window[-1][3])
                if gap:  # nothing shorter is left
                    for piece in reversed(window):
                        self._wait(piece)
                    break
                self._emit(window, tier)
        if last:
            self._finish()
        rows, self.rows = self.rows, []
        return rows

    def _finish(self) -> None:
        rest = deque(p for t in self.tiers for p in self.waiting[t])
        tokens = sum(len(p[3]) for p in rest)
        for t in self.tiers:
            self.waiting[t].clear()
        while tokens:
            size = min(self.tiers[0], 1 << tokens.bit_length() - 1)
            window, gap = [], size
            while gap:
                doc, n, start, ids = rest.popleft()
                if len(ids) > gap:
                    rest.appendleft((doc, n, start + gap, ids[gap:]))
                window.append((doc, n, start, ids[:gap]))
                gap -= len(window[-1][3])
            self._emit(window, size)
            tokens -= size

    def _emit(self, window, size: int) -> None:
        step = self.open_steps.get(size)
        if step is None:
            step = self.open_steps[size] = [self.next_step, 0]
            self.next_step += 1
        offset = 0
        for doc, n, start, ids in window:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), n, self.next_sequence, offset, size, step[0], ids))
            offset += len(ids)
        self.next_sequence += 1
        step[1] += size
        if step[1] >= self.step_tokens:
            del self.open_steps[size]


def pack(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 0,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece; with ``with_ids`` also its token ids. ``tiers`` are falling powers of two.

    ``remembered`` bounds the memory of the encoders, not the result.
    """
    small_batches(docs.sparkSession)
    schema = _SCHEMA + (", ids array<int>" if with_ids else "")

    def frame(rows):
        columns = list(zip(*rows)) if rows else [[]] * 10
        arrays = [pa.array(c, pa.int32() if name == "tier" else pa.int64()) for name, c in zip(_FIELDS, columns)]
        names = list(_FIELDS)
        if with_ids:
            parts = columns[9]
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            joined = np.concatenate(parts).astype(np.int32) if len(parts) else np.empty(0, np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(joined)))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches):
        encode = encoder(tokenizer, True, remembered)
        packer = Packer(tiers, TaskContext.get().partitionId() << 33, step_tokens)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            ids = encode([t or "" for t in batch.column(1).to_pylist()])
            for doc, own in zip(batch.column(0).to_pylist(), ids):
                packer.add(doc, np.concatenate([own, end]))
            yield frame(packer.pack())
        yield frame(packer.pack(last=True))

    return docs.select("doc_id", "text").mapInArrow(run, schema)
