"""SentencePiece encoding and decoding with an Aho-Corasick automaton.

All ordinary pieces of the model are in one automaton.  A single pass over a text
reports, at each position, the pieces that end there (longest first, then along
the output links); each relaxes the best score of its end from that of its
start (Viterbi), so one scan gives the segmentation with the greatest sum of
piece scores.  On equal sums the longer last piece wins.  A character in no
piece costs the least piece score less 10 and becomes its UTF-8 bytes.

As in the model, a blank is written as U+2581 and one is put in front of the
text.  Where no piece goes on past a following U+2581, the best segmentation of
a text is that of its blank-separated units in turn, so each distinct unit is
scanned once per worker; otherwise whole texts are scanned.

Decoding joins the pieces, turns byte pieces into bytes, U+2581 into a blank and
drops the first blank.  ``decode(encode(x)) == x`` for every text without U+2581
(which reads back as a blank).

Note: the models at hand were made for pair merging; their scores order the
merges.  The best-sum segmentation under those scores is well defined and round
trips, but can differ from the merge order's.

Defined cases: a null text has null ids, an empty text no ids; null ids decode to
null; ids outside the vocabulary are an error; repeated rows and null row ids
are kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corvid.llm.common import byte_slices

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
MEMO_UNITS = 200_000
ROWS = 256          # rows decoded at a time


class Codec:
    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = model.get_piece_size()
        self.byte_id = {}
        self.raw: list[bytes] = []
        self.pieces: dict[str, tuple[int, float]] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_id[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"" if model.is_control(i) else " ⁇ ".encode())
            else:
                self.pieces[piece] = (i, model.get_score(i))
                self.raw.append(piece.replace(BLANK, " ").encode())
        self.unknown_id = model.unk_id()
        self.unknown = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        # may a text be cut before a blank that follows another character?
        self.separable = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.pieces)
        self.memo: dict[str, bytes] = {}

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation of a text with blanks already written as U+2581."""
        n = len(text)
        best, back = [0.0] + [float("-inf")] * n, [(0, -1)] * (n + 1)
        unknown, done = self.unknown, 0
        for end, (length, i, score) in self.automaton.iter(text):
            start = end + 1 - length
            while done < start:            # close the positions before: an unknown character may lead there
                done += 1
                if best[done - 1] + unknown > best[done]:
                    best[done], back[done] = best[done - 1] + unknown, (done - 1, -1)
            total = best[start] + score
            if total > best[end + 1]:
                best[end + 1], back[end + 1] = total, (start, i)
        while done < n:
            done += 1
            if best[done - 1] + unknown > best[done]:
                best[done], back[done] = best[done - 1] + unknown, (done - 1, -1)
        out: list[int] = []
        at = n
        while at:
            start, i = back[at]
            if i >= 0:
                out.append(i)
            else:
                data = text[start:at].encode("utf-8", "surrogatepass")
                out += [self.byte_id.get(b, self.unknown_id) for b in reversed(data)] if self.byte_id else [self.unknown_id]
            at = start
        return out[::-1]

    def _unit(self, unit: str) -> bytes:
        found = self.memo.get(unit)
        if found is None:
            found = np.array(self.segment(unit), "<i4").tobytes()
            if len(unit) <= 64:
                if len(self.memo) >= MEMO_UNITS:
                    self.memo.clear()
                self.memo[unit] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian int32."""
        if not text:
            return b""
        marked = BLANK + text.replace(" ", BLANK)
        if not self.separable:
            return np.array(self.segment(marked), "<i4").tobytes()
        if BLANK + BLANK in marked:
            units = re.findall(f"{BLANK}+[^{BLANK}]*", marked)
        else:
            units = [BLANK + u for u in marked[1:].split(BLANK)]
        return b"".join(map(self._unit, units))

    def decode(self, ids) -> str:
        data = b"".join(map(self.raw.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(model_path: str) -> Codec:
    return Codec(model_path)


def encode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` plus the ids of each whole text; a column that has their name already gives way."""
    df = df.drop(ids_col)
    at = df.columns.index(text_col)

    def run(batches):
        c = codec(model_path)
        for batch in batches:
            for part in byte_slices(batch, at):
                texts = part.column(at).to_pylist()
                data = [c.encode(t) if t is not None else b"" for t in texts]
                off = np.concatenate([[0], np.cumsum([len(d) // 4 for d in data])]).astype(np.int32)
                ids = pa.array(np.frombuffer(b"".join(data), "<i4"))
                mask = pa.array([t is None for t in texts])
                cell = pa.ListArray.from_arrays(pa.array(off), ids, mask=mask)
                yield pa.RecordBatch.from_arrays([*part.columns, cell], names=[*part.schema.names, ids_col])

    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` plus the text of each id sequence; a column that has its name already gives way."""
    df = df.drop(text_col)
    at = df.columns.index(ids_col)

    def run(batches):
        c = codec(model_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                cells = part.column(at)
                off, flat = np.asarray(cells.offsets), np.asarray(cells.values)
                valid = np.asarray(cells.is_valid())
                texts = [c.decode(flat[a:b].tolist()) if ok else None for a, b, ok in zip(off[:-1], off[1:], valid)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*part.schema.names, text_col])

    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(text_col, T.StringType())]))
