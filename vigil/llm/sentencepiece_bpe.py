"""SentencePiece BPE, encoded exactly by backtracking, and decoded.

A sequence of pieces is the encoding of a text when every two neighbours, merged anew from single characters, give
the same two pieces.  So the encoder goes from left to right: an Aho-Corasick automaton over the pieces lists those
that begin at each position, the longest is tried first, and a piece is taken if it is compatible with the one before.
Where none fits, the position is marked as failed in a bitfield and the encoder steps back to a shorter piece.
Compatibility is decided by merging the pair anew and remembered.  The time is linear in the text.

Pieces never reach across a pair of characters that occurs side by side in no piece, so a text falls into chunks
(mostly words with the mark before) whose encodings are independent; frequent chunks are remembered per worker.

Null text counts as empty, which has no ids.  Texts and chunks may be of any length.  Every row gives one result,
repeated or not; an empty table gives none.  Other columns are ignored.  Only BPE models with byte fallback and the identity normalizer are taken,
others are refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.shared import whole_text

MARK = "▁"
CHUNKS = 400_000
CHUNK_LENGTH = 48
PAIRS = 500_000
NEVER = float("inf")

_CODECS: dict[str, Codec] = {}


class Codec:
    """Vocabulary of a model file, its encoder and its decoder."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.probe = model
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        normal = [i for i in range(len(self.pieces)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.rank = {self.pieces[i]: -model.get_score(i) for i in normal}
        self.id = {self.pieces[i]: i for i in normal}
        self.normal = set(normal)
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        if len(self.bytes) != 256 or any(model.is_unused(i) for i in normal) or model.encode("ﬁ  a", out_type=str)[-2:] != [MARK, MARK + "a"]:
            raise ValueError("needs a BPE model with byte fallback that keeps its text as it is")
        self.silent = {i for i in range(len(self.pieces)) if model.is_control(i)}
        self.together = {p[k : k + 2] for p in self.rank for k in range(len(p) - 1)}
        if any(x[1] == MARK and x[0] != MARK for x in self.together):
            raise ValueError("pieces must not reach over a space")
        # Line ends and tabs are in no piece but alone: they part chunks like spaces do.
        alone = "".join(c for c in "\n\t" if not any(c in x for x in self.together))
        self.chunk = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + f"|[{alone}]+" * bool(alone))
        self.automaton = ahocorasick.Automaton()
        for piece in self.rank:
            if len(piece) > 1 and self._merged(piece) == [piece]:  # pieces that no merging reaches are never used
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known = _Chunks(self)
        #: What ids stand for that need no neighbour to be read: pieces, and bytes that are a character alone.
        self.surfaces = {i: self.pieces[i].replace(MARK, " ") for i in normal} | {i: chr(b) for b, i in self.bytes.items() if b < 0x80}

    def _merged(self, text: str) -> list[str]:
        """Merging by the definition: the best pair first, the leftmost of equals; for short texts."""
        rank, parts = self.rank.get, list(text)
        ranks = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) < NEVER:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], NEVER)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two pieces, merged anew from their characters, come out the same."""
        if left[-1] + right[0] not in self.together:
            return True
        key = (left, right)
        answer = self.pairs.get(key)
        if answer is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            answer = self.pairs[key] = self._merged(left + right) == [left, right]
        return answer

    def backtrack(self, text: str) -> list[str]:
        """Pieces of a text; characters without a piece stand alone."""
        n = len(text)
        begin = [[i] for i in range(1, n + 1)]  # ends of the pieces that begin here, shortest first; a character is one
        for end, length in self.automaton.iter(text):
            begin[end - length + 1].append(end + 1)
        failed = bytearray(n // 8 + 1)  # bit i: the first i characters have no encoding that can be carried on
        together, pairs = self.together, self.pairs
        taken: list[str] = []
        choices: list[int] = []
        at, choice = 0, -1  # choice: how many of the pieces that begin here are still to be tried, -1 all
        while at < n:
            ends = begin[at]
            if choice < 0:
                choice = len(ends)
            # Where no piece reaches over this border, all neighbours are compatible.
            free = not taken or text[at - 1 : at + 1] not in together
            while choice:
                choice -= 1
                end = ends[choice]
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                piece = text[at:end]
                if not free:
                    fits = pairs.get((taken[-1], piece))
                    if not (self.compatible(taken[-1], piece) if fits is None else fits):
                        continue
                taken.append(piece)
                choices.append(choice)
                at, choice = end, -1
                break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(taken.pop())  # a text always has an encoding, so something was taken
                choice = choices.pop()
        return taken

    def piece_ids(self, text: str) -> list[int]:
        """Ids of a text in which spaces are marks already."""
        ids: list[int] = []
        for piece in self.backtrack(text):
            known = self.id.get(piece)
            if known is None:
                ids.extend(self.bytes[b] for b in piece.encode())
            else:
                ids.append(known)
        return ids

    def chunks(self, text: str) -> list[str]:
        return self.chunk.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        joined = self.joined(text)
        return list(map(int, joined.split(","))) if joined else []

    def joined(self, text: str) -> str:
        """Decimal ids joined by commas."""
        return ",".join(map(self.known.__getitem__, self.chunks(text)))

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: runs of byte pieces as UTF-8 with replacement, marks as spaces, without the one put in front."""
        ids = list(ids)
        try:
            text = "".join(map(self.surfaces.__getitem__, ids))
        except KeyError:  # bytes that need their neighbours, control pieces or the unknown one
            text = self._by_runs(ids)
        return text[1:] if ids and ids[0] in self.normal and self.pieces[ids[0]][0] == MARK else text

    def _by_runs(self, ids: list[int]) -> str:
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(replaced(bytes(run)))
                run.clear()
            if i not in self.silent:
                out.append(self.surfaces.get(i, " ⁇ "))
        return "".join(out) + replaced(bytes(run))


def replaced(data: bytes) -> str:
    """UTF-8 bytes as text; every byte that is part of no whole character becomes one replacement character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as wrong:
            out.append(data[at : at + wrong.start].decode() + "�")
            at += wrong.start + 1
    return "".join(out)


class _Chunks(dict):
    """Ids of chunks as text, each encoded once."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec, self.before = codec, {}

    def __missing__(self, chunk: str) -> str:
        ids = self.before.get(chunk)
        if ids is None:
            ids = self._appended(chunk) or ",".join(map(str, self.codec.piece_ids(chunk)))
        if len(chunk) <= CHUNK_LENGTH:
            if len(self) >= CHUNKS:
                self.before = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def _appended(self, chunk: str) -> str | None:
        """Ids of a known chunk and its last character, where those are compatible neighbours."""
        stem, last = chunk[:-1], chunk[-1]
        if last in ".,;:!?" and last in self.codec.id and len(stem) <= CHUNK_LENGTH and stem not in ("", MARK):
            ids = self[stem]
            end = self.codec.pieces[int(ids.rpartition(",")[2])]
            if self.codec.id.get(end) is not None and self.codec.compatible(end, last):
                return f"{ids},{self.codec.id[last]}"
        return None


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def round_trip(path: str, text: str) -> tuple[list[int], str, str]:
    """The ids of a text, the same joined by commas, and the text decoded from them."""
    coder = codec(path)
    joined = coder.joined(text)
    ids = np.fromstring(joined, np.int32, sep=",").tolist()
    return ids, joined, coder.decode(ids)


def encoded(path: str, text: Column) -> Column:
    """Column of id arrays."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        coder = codec(path)
        return pd.Series([np.array(coder.encode(x), dtype=np.int32) for x in texts])

    return ids(F.coalesce(text, F.lit("")))


def decoded(path: str, ids: Column) -> Column:
    """Column of texts from id arrays; a null array gives the empty text."""

    @F.pandas_udf("string")
    def texts(arrays: pd.Series) -> pd.Series:
        coder = codec(path)
        return pd.Series(["" if x is None else coder.decode(x) for x in arrays])

    return texts(ids)


def digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document, and with ``with_ids`` the ``ids``."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
    def digest(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            ids, joined, back = round_trip(path, text)
            codes = [np.array(ids, dtype=np.int32)] * with_ids
            rows.append((len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), *codes))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])

    return docs.select("doc_id", digest(whole_text()).alias("r")).select("doc_id", "r.*")
