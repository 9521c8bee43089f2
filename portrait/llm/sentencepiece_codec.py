"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is normalised as the vocabulary file expects (a leading blank, blanks
written as U+2581) and segmented into the pieces of highest total score.  The
search keeps scores for the last ``longest piece`` positions only; pieces are
committed as soon as the back pointers of all positions that can still be
extended meet in one boundary.  Characters outside the vocabulary cost
``min score - 10`` and become their UTF-8 byte pieces, and so does a literal
U+2581, which makes decoding an exact inverse.

If no piece holds a U+2581 after another character, every path has a boundary
in front of each blank run (and around line ends, if no piece holds one); the
text is then searched run by run and the result of short runs is remembered (a
bounded table a worker), which changes no id.  Decoding is checked for each run
as it is searched; decoding a text is decoding its runs in turn.

At equal score the path whose last piece is longest wins, at every position.
Defined cases: null and empty texts give no ids and decode to the empty text;
very long texts are streamed; repeated rows give repeated results; other
columns are not read.  The vocabulary (some 32,000 pieces) is read on the driver
and travels with the tasks.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
LITERAL = "\ud800"         # stands for a U+2581 of the text itself; never valid in UTF-8
MEMO_ENTRIES = 1_000_000
MEMO_CHARS = 40
UNKNOWN_COST = 10.0


class Vocabulary:
    """Pieces of a model file: scores and ids by piece, bytes by id."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.pieces, self.byte_ids = pieces, byte_ids
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_COST
        self.bytes = {i: p.replace(BLANK, " ").encode() for p, (i, _) in pieces.items()}
        self.bytes |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.starts: dict[str, tuple[int, float] | None] = {p[:i]: None for p in pieces for i in range(1, len(p))}
        self.starts |= pieces                               # what a piece begins with: its piece, if it is one
        self.splits = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces)
        self.lines = self.splits and not any("\n" in p for p in pieces)
        self.digest = hashlib.sha256(repr((sorted(pieces.items()), byte_ids)).encode()).hexdigest()   # of all pieces

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        return cls({sp.id_to_piece(i): (i, sp.get_score(i)) for i in plain},
                   [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.memo: dict[str, bytes] = {}                    # by run; a leading blank is left out, see encode
        self.run = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+") if vocabulary.splits else None

    def _byte_ids(self, char: str) -> list[int]:
        return [self.v.byte_ids[b] for b in (BLANK if char == LITERAL else char).encode()]

    def search(self, text: str) -> array:
        """Streaming Viterbi over one run of characters."""
        starts, unknown, longest = self.v.starts, self.v.unknown, self.v.longest
        n, out = len(text), array("i")
        best: dict[int, float] = {0: 0.0}                       # scores of the window
        back: dict[int, tuple[int, int]] = {}                   # start and id of a position's last piece
        done = 0
        for i in range(n):
            here = best.pop(i)
            for at in range(i + 1, min(n, i + longest) + 1):
                hit = starts.get(text[i:at], ())
                if not hit:
                    if at == i + 1 and i + 1 not in best:
                        best[at], back[at] = here + unknown, (i, -1)
                    if hit is None:
                        continue
                    break
                score = here + hit[1]
                if at not in best or score > best[at]:          # earlier starts come first: longest last piece
                    best[at], back[at] = score, (i, hit[0])
            if i - done >= 2 * longest:
                done = self._commit(text, back, done, best, out)
        if n:
            self._emit(text, back, done, n, out)
        return out

    def _commit(self, text: str, back: dict, done: int, best: dict[int, float], out: array) -> int:
        live = set(best)
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(back[top][0])
        at = live.pop()
        if at > done:
            self._emit(text, back, done, at, out)
            for j in range(done + 1, at + 1):
                back.pop(j, None)
        return max(at, done)

    def _emit(self, text: str, back: dict, start: int, stop: int, out: array) -> None:
        path = []
        while stop > start:
            begin, piece = back[stop]
            path.append((begin, piece))
            stop = begin
        for begin, piece in reversed(path):
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self._byte_ids(text[begin]))

    def _searched(self, key: str) -> bytes:
        """Ids of a run by its key: with a leading blank unless it begins with
        a line end, or a blank or literal mark says it is written out."""
        text = key if key[:1] in ("\n", BLANK, LITERAL) else BLANK + key
        ids = self.search(text)
        if b"".join(map(self.v.bytes.__getitem__, ids)).decode() != text.replace(BLANK, " ").replace(LITERAL, BLANK):
            raise ValueError(f"{text!r} does not decode to itself")
        got = ids.tobytes()
        if len(key) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            self.memo[key] = got
        return got

    def encoded(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers."""
        if not text:
            return b""
        if (self.v.lines and BLANK not in text and "  " not in text and " \n" not in text
                and text[0] not in " \n" and text[-1] != " "):
            runs = text.replace("\n", " \n").split(" ")    # every run by its key
        else:
            text = BLANK + text.replace(BLANK, LITERAL).replace(" ", BLANK)
            if self.run is None:
                return self.search(text).tobytes()
            # as keys: "word" stands for a blank and the word
            runs = [r[1:] if r[0] == BLANK and r[1:2] not in ("", BLANK, "\n", LITERAL) else r for r in self.run.findall(text)]
        parts = list(map(self.memo.get, runs))
        if None in parts:
            parts = [self.memo.get(r) or self._searched(r) if p is None else p for r, p in zip(runs, parts, strict=True)]
        return b"".join(parts)

    def encode(self, text: str) -> array:
        return array("i", self.encoded(text))

    def decode(self, ids) -> str:
        raw = b"".join(map(self.v.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return raw[1:] if raw[:1] == " " else raw


_CODECS: dict[str, Codec] = {}


def _codec(vocabulary: Vocabulary) -> Codec:
    """One codec a worker for each vocabulary, so that its memory outlives a task."""
    if vocabulary.digest not in _CODECS:
        _CODECS.clear()
        _CODECS[vocabulary.digest] = Codec(vocabulary)
    return _CODECS[vocabulary.digest]


def _encoder(vocabulary: Vocabulary):
    def run(batches):
        codec = _codec(vocabulary)
        for batch in batches:
            step = 1024
            for row in range(0, batch.num_rows, step):
                ids = [codec.encoded(x or "") for x in batch.column(1).slice(row, step).to_pylist()]
                counts = np.array([len(x) // 4 for x in ids], np.int64)
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, step), pa.array(counts), lists],
                                                 names=["doc_id", "n_tokens", "ids"])
    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_tokens and ids (which decode to the text, or the job fails)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encoder(vocabulary), "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of encoded rows; null ids are the empty text."""
    def run(batches):
        codec = _codec(vocabulary)
        for batch in batches:
            texts = [codec.decode(x.as_py() or ()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])
    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")
