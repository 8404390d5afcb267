"""Encoding and decoding with a SentencePiece model of merge type, exactly as merging in order of score does.

Instead of running merges over the text, the encoder searches for the one sequence of tokens in which every adjacent
pair is compatible, that is, merging the joined text of the pair again gives the same pair. At each place it tries the
longest token that an Aho-Corasick automaton found to begin there, then its shorter prefixes; when none fits, the place is
marked in a bitfield as failed and the last token is taken back. A failed place is never entered again, so the work is
linear in the text, and no text is too long for it.

No token of such a vocabulary has a space mark after another character, so texts are cut before each run of
space marks, at characters that no token holds, and between characters that are never neighbours in a token; the parts are encoded once for each worker, in a bounded cache.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MARK = "▁"
#: Parts of text in each of a worker's two cache generations, about 220 bytes each.
CACHE_PARTS = 200_000
ROWS_A_SLICE = 500


class PieceCodec:
    """Vocabulary and search of one model file. Only the vocabulary is read through the library."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.pieces = [model.id_to_piece(i) for i in ids]
        self.bytes_id = {int(self.pieces[i][1:-1], 16): i for i in ids if model.is_byte(i)}
        self.unknown = model.unk_id()
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        plain_set = set(plain)
        texts = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode() if i in plain_set else " ⁇ ".encode() if i == self.unknown else b"" for i, p in enumerate(self.pieces)]
        self.blob, self.lengths = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.id_of = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: model.get_score(i) for i in plain}
        #: Only tokens that merging can reach from their own characters are ever produced.
        self.reached = {p for p in self.id_of if len(p) == 1 or self.merged(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p in self.reached:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        #: For each path of the automaton's trie the longest token on it.
        self.on_path: dict[str, str] = {}
        for p in sorted(self.reached, key=len):
            for k in range(1, len(p)):
                self.on_path.setdefault(p[:k], next((p[:j] for j in range(k, 1, -1) if p[:j] in self.reached), p[0]))
            self.on_path[p] = p
        self.width = max(map(len, self.reached))
        self.shorter: dict[str, str] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        characters = {c for p in self.id_of for c in p}
        breaks = "".join(c for c in "\n\r\t" if c not in characters)
        self.cuts = all(MARK not in p.lstrip(MARK) for p in self.id_of)
        stop = re.escape(breaks)
        #: Marks that no token holds right after a letter or digit: a cut between the two changes nothing.
        apart = set(".,;:!?") - {b for p in self.id_of for a, b in zip(p, p[1:], strict=False) if a.isalnum()}
        before = f"{MARK}*[^\\W_]+(?=[{re.escape(''.join(sorted(apart)))}])|" if apart else ""
        self.parts = re.compile(f"{before}{MARK}*[^{MARK}{stop}]+|{MARK}+" + (f"|[{stop}]" if breaks else ""))
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Adjacent symbols merged by score, the leftmost first among equals. For short texts."""
        symbols = list(text)
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                s = self.score.get(symbols[k] + symbols[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 4 * CACHE_PARTS:
                self.fits.clear()
            known = self.fits[left, right] = self.merged(left + right) == [left, right]
        return known

    def prefix(self, token: str) -> str:
        """The next shorter token with which this one begins, or nothing."""
        known = self.shorter.get(token)
        if known is None:
            known = next((token[:k] for k in range(len(token) - 1, 0, -1) if k == 1 or token[:k] in self.reached), "")
            self.shorter[token] = known
        return known

    def search(self, text: str) -> list[str]:
        """The tokens of a text, as strings; a character outside the vocabulary stands for itself."""
        n, fits, deepest, path, width = len(text), self.fits.get, self.automaton.longest_prefix, self.on_path.get, self.width
        failed, any_failed = bytearray(n // 8 + 1), False
        tokens: list[str] = []
        at, last, token = 0, "", ""
        while at < n:
            if not token:  # the longest token that begins here, or one character
                rest = text[at : at + width]
                token = path(rest[: deepest(rest)], text[at])
            while token:
                end = at + len(token)
                if not any_failed or not failed[end >> 3] >> (end & 7) & 1:
                    fit = fits((last, token)) if last else True
                    if fit or fit is None and self.compatible(last, token):
                        break
                token = self.shorter.get(token) or self.prefix(token)
            if token:
                tokens.append(token)
                at, last, token = end, token, ""
            else:
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                token = tokens.pop()
                at -= len(token)
                last = tokens[-1] if tokens else ""
                token = self.prefix(token)
                if not token:  # a single character that can't stand here either: take back one more
                    while not token:
                        failed[at >> 3] |= 1 << (at & 7)
                        token = tokens.pop()
                        at -= len(token)
                        token = self.prefix(token)
                    last = tokens[-1] if tokens else ""
        return tokens

    def ids(self, text: str) -> list[int]:
        out: list[int] = []
        tokens = self.search(text)
        try:
            return [self.id_of[t] for t in tokens]
        except KeyError:
            pass  # a character outside the vocabulary: its bytes stand for it
        for t in tokens:
            known = self.id_of.get(t)
            if known is not None:
                out.append(known)
            elif self.bytes_id:
                out += [self.bytes_id[b] for b in t.encode()]
            else:
                out.append(self.unknown)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sentence's ids: their bytes in a row, without the first space."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - ends + n, n)
        data = self.blob[at].tobytes()
        try:
            return data.decode().removeprefix(" ")
        except UnicodeDecodeError:
            return _lenient(data).removeprefix(" ")

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return self.parts.findall(marked) if self.cuts else [marked]

    def part(self, part: str) -> bytes:
        """ids as bytes. The cache has two generations; parts that are asked for again move to the young one."""
        found = self.cache.get(part) or self.old.get(part) or array("i", self.ids(part)).tobytes()
        if len(part) <= 64:
            if len(self.cache) >= CACHE_PARTS:
                self.old = self.cache
                self.cache = {}
            self.cache[part] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        part = self.part
        return np.frombuffer(b"".join([self.cache.get(p) or part(p) for p in self.split(text)]), np.int32)


def _lenient(data: bytes) -> str:
    """UTF-8 in which each byte that begins no character stands for the replacement character."""
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("\ufffd")
            at += 1
    return "".join(out)


@lru_cache(2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_pieces(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """One row per input row: doc_id, ids array<int>, and decoded, the text that the ids give.

    A null or empty text has no ids and decodes to the empty text. Ids may be null or repeat; other columns are ignored;
    an empty table gives an empty result. Works row by row, so no key or group matters; a long text costs its own length.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in it:
            for k in range(0, batch.num_rows, ROWS_A_SLICE):
                part = batch.slice(k, ROWS_A_SLICE)
                ids, texts = [], []
                for text in part.column(1):
                    ids.append(c.encode(text.as_py() or ""))
                    texts.append(c.decode(ids[-1]) if decoded else "")
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())] if decoded else columns, names=["doc_id", "ids", "decoded"][: 2 + decoded])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded)


def decode_pieces(rows: DataFrame, model_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: doc_id, decoded. Null ids decode to the empty text."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in it:
            texts = [c.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, decoded string")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """n_tokens and the digests of ids and decoded text, and more columns of the input."""
    return encoded.select("doc_id", *more, F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    return digests(encode_pieces(table(spark, sf_dir, "documents"), model_path or default_model()))
