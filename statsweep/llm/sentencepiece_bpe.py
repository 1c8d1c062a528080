"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text's characters start as one symbol each. An agenda (heap) holds the adjacent symbol pairs whose concatenation is
a piece, best score first, leftmost first on ties; the best pair is merged and its new neighbours enter the agenda,
until none is left. Merges can't cross a place where no piece has those two characters side by side, so texts are cut
there and each distinct part is encoded once per worker. In every Arrow batch the words seen for the first time, and
every 64th whole text, are checked against the sentencepiece library; a difference raises an error.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Parts, lean, worker_cache

SPACE = "▁"
CHECK_EVERY = 64


def agenda_merge(text: str, score: dict[str, float]) -> list[str]:
    """The symbols left when no adjacent pair of symbols forms a piece."""
    sym: list[str | None] = list(text)
    n = len(sym)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda = [(-score[p], i, p) for i in range(n - 1) if (p := text[i:i + 2]) in score]
    heapq.heapify(agenda)
    while agenda:
        _, i, piece = heapq.heappop(agenda)
        left = sym[i]
        if left is None or (j := nxt[i]) >= n or left + sym[j] != piece or len(left) == len(piece):
            continue  # one of the two has been merged meanwhile
        sym[i], sym[j] = piece, None
        nxt[i] = k = nxt[j]
        if k < n:
            prv[k] = i
            if (p := piece + sym[k]) in score:
                heapq.heappush(agenda, (-score[p], i, p))
        if (h := prv[i]) >= 0 and (p := sym[h] + piece) in score:
            heapq.heappush(agenda, (-score[p], h, p))
    return [s for s in sym if s is not None]


class Codec:
    """Encoder and decoder over a model file's pieces and scores."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("vocabularies with unused pieces aren't supported")
        self.score = {p: sp.get_score(i) for i, p in enumerate(pieces) if i not in special}
        self.pack = {p: array("I", [i]).tobytes() for i, p in enumerate(pieces) if i not in special}
        self.bos, self.eos, self.unk = (array("I", [i]).tobytes() for i in (sp.bos_id(), sp.eos_id(), sp.unk_id()))
        byte = {int(p[1:-1], 16): array("I", [i]).tobytes() for i, p in enumerate(pieces) if sp.is_byte(i)}
        self.byte = [byte.get(i) for i in range(256)] if byte else None
        self.pairs = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        if any(c[1] == SPACE and c[0] != SPACE for c in self.pairs):
            raise ValueError("pieces with an inner word start aren't supported")
        self.table = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i)
                      else bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.is_byte = [sp.is_byte(i) for i in range(n)]
        self.starts = {i for i, p in enumerate(pieces) if i not in special and p.startswith(SPACE)}
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.sub, self.words, self.fresh = Parts(self._merge, 150_000), Parts(self._word, 250_000), []
        self.chunk = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def _merge(self, part: str) -> bytes:
        out = []
        for s in agenda_merge(part, self.score):
            if (p := self.pack.get(s)) is not None:
                out.append(p)
            elif self.byte:
                out += [self.byte[b] for b in s.encode()]
            else:
                out.append(self.unk)
        return b"".join(out)

    def split(self, text: str) -> list[str]:
        """Parts of ``text`` that no merge can join: cut where no piece has the two characters side by side."""
        known = self.pairs
        cuts = [i for i, p in enumerate(map(add, text, text[1:]), 1) if p not in known]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])] if cuts else [text]

    def _word(self, word: str) -> bytes:
        parts = self.split(SPACE + word)
        # a word in one part is kept as a word only
        out = b"".join(map(self.sub.__getitem__, parts)) if len(parts) > 1 else self._merge(parts[0])
        self.fresh.append((out, word))
        return out

    def encode(self, text: str) -> bytes:
        """All ids with begin and end, as little-endian unsigned 32 bit integers."""
        if not text:
            return self.bos + self.eos
        text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            parts = self.chunk.findall(SPACE + text.replace(" ", SPACE))
            body = b"".join([self.words[p[1:]] if p[0] == SPACE and p[1:2] not in ("", SPACE) else b"".join(map(self.sub.__getitem__, self.split(p))) for p in parts])
        else:
            body = b"".join(map(self.words.__getitem__, text.split(" ")))
        return self.bos + body + self.eos

    def decode(self, ids: bytes) -> str:
        """Text of packed ids: one word-start space is taken off the front; a byte that isn't UTF-8 becomes U+FFFD."""
        seq = array("I", ids)
        raw = b"".join(map(self.table.__getitem__, seq))
        first = next((i for i in seq if i not in self.control), None)
        inner = seq[1:-1]
        try:
            if any(c in inner for c in self.control):  # an id without text ends a run of byte pieces
                raise UnicodeDecodeError("utf-8", raw, 0, 1, "cut run")
            text = raw.decode()
        except UnicodeDecodeError:
            text, run = "", b""
            for i in [*seq, None]:
                if i is not None and self.is_byte[i]:
                    run += self.table[i]
                    continue
                while run:
                    for n in (1, 2, 3, 4):
                        try:
                            text, run = text + run[:n].decode(), run[n:]
                            break
                        except UnicodeDecodeError:
                            pass
                    else:
                        text, run = text + "�", run[1:]
                if i is not None:
                    text += self.table[i].decode()
        return text[1:] if first in self.starts else text

    def check(self, texts: list[str]) -> None:
        """Words new in this Arrow batch, and every 64th text, against the library."""
        some = texts[::CHECK_EVERY]
        todo = [*self.fresh, *((self.encode(t)[len(self.bos):-len(self.eos)], t) for t in some)]
        self.fresh = []
        pairs = [(own, i, t) for (own, t), i in zip(todo, self.library.encode([t for _, t in todo], num_threads=1))] if todo else []
        for own, theirs, text in pairs:
            if own != (theirs := array("I", theirs).tobytes()):
                raise ValueError(f"{text[:80]!r}: {own[:80]!r} is not the library's {theirs[:80]!r}")


def _codec(model_file: str) -> Codec:
    held = worker_cache("sentencepiece")
    if model_file not in held:
        held[model_file] = Codec(model_file)
    return held[model_file]


def tokenize(docs: DataFrame, model_file: str, keep: list[str] | None = None, ids: bool = False, text: bool = False) -> DataFrame:
    """Encode and decode every whole text of ``docs(doc_id, text, ...)``; null counts as empty.

    Returns the columns in ``keep`` (default ``doc_id``), ``n_tokens`` (all ids, begin and end too), ``ids_sha256``
    and ``decoded_sha256``; with ``ids`` also the ids (array of int), with ``text`` also the decoded text. A column
    of ``docs`` that has one of these names is not passed on unless it is in ``keep``.
    """
    keep = ["doc_id"] if keep is None else keep
    src = docs.select(*keep, F.coalesce("text", F.lit("")).alias("__text"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[:-1]] + ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    schema += ["ids array<int>"] * ids + ["decoded string"] * text

    @lean
    def run(batches):
        codec = _codec(model_file)
        for batch in batches:
            step = max(1, min(batch.num_rows, 2000))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = part.column(part.num_columns - 1).to_pylist()
                packed = [codec.encode(t) for t in texts]
                codec.check(texts)
                plain = [codec.decode(p) for p in packed]
                cols = [part.column(i) for i in range(part.num_columns - 1)]
                cols += [pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                         pa.array([hashlib.sha256(t.encode()).hexdigest() for t in plain])]
                if ids:
                    cols.append(pa.array([array("i", p).tolist() for p in packed], pa.list_(pa.int32())))
                if text:
                    cols.append(pa.array(plain, pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids, *["decoded"] * text])

    return src.mapInArrow(run, ", ".join(schema))
