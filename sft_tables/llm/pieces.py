"""SentencePiece encoding and decoding with a merge-type vocabulary, by a table of prefixes.

Merge encoding has a property that makes it linear: every prefix of a text has one encoding, and its last token alone
says how to go on. The table holds, for each prefix, that last token: of the vocabulary's pieces that end there (an
automaton finds them), the only one that is its own encoding and that the token before it leaves alone (a pair test).
Ids are then read backwards from the end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from sft_tables.llm.common import give_back, read_table, slices

SPACE = "▁"
NORMAL, BYTE = 1, 6
#: Segments kept from one text to the next within a task, and pair tests kept by a worker; when full, they are emptied. Speed only.
CACHED, PAIRS = 600_000, 300_000


class Vocabulary:
    """The pieces of a merge model with byte fallback, its prefix tables and its decoder."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        plain = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or plain.precompiled_charsmap or plain.remove_extra_whitespaces or not plain.add_dummy_prefix:
            raise ValueError("a merge model without text normalisation is needed")
        self.pieces = [p.piece for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece goes on past the end of a word")
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if self.merged(piece) == [piece]:
                self.automaton.add_word(piece, (self.ids[piece], len(piece)))
        self.automaton.make_automaton()
        self.lengths = [len(p) for p in self.pieces]
        self.compatible: dict[int, bool] = {}
        self.cache: dict[str, tuple[str, int, str]] = {}

    def merged(self, text: str) -> list[str]:
        """The definition: merge the neighbours whose union scores best, leftmost first, until none is a piece."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            found = [(-scores[u], i) for i in range(len(parts) - 1) if (u := parts[i] + parts[i + 1]) in scores]
            if not found:
                break
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def pair(self, left: int, right: int) -> bool:
        """Does ``right`` after ``left`` stay as it is?"""
        if len(self.compatible) >= PAIRS:
            self.compatible.clear()
        left_piece, right_piece = self.pieces[left], self.pieces[right]
        known = self.compatible[left << 20 | right] = self.merged(left_piece + right_piece) == [left_piece, right_piece]
        return known

    def ids_of(self, segment: str) -> list[int]:
        """The ids of a segment; a character without a piece is a token of its own, written as its bytes."""
        last = [-1] * (len(segment) + 1)
        compatible, pair = self.compatible, self.pair
        for end, (piece, length) in self.automaton.iter(segment):
            end += 1
            if last[end] < 0:
                before = last[end - length]
                if before < 0:
                    # the start, or a character that merges with nothing
                    last[end] = piece
                else:
                    known = compatible.get(before << 20 | piece)
                    if known or known is None and pair(before, piece):
                        last[end] = piece
        ids, end, lengths = [], len(segment), self.lengths
        while end:
            piece = last[end]
            if piece < 0:
                end -= 1
                ids.extend([self.byte_ids[b] for b in reversed(segment[end].encode())])
            else:
                ids.append(piece)
                end -= lengths[piece]
        return ids[::-1]

    def decoded(self, ids: list[int]) -> str:
        """Text of the ids, without the rule for the first blank; broken byte sequences become U+FFFD."""
        out, run = [], bytearray()
        for i in ids:
            byte = self.bytes_of.get(i)
            if byte is not None:
                run.append(byte)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.pieces[i].replace(SPACE, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def segment(self, word: str) -> tuple[str, int, str]:
        """(ids joined by commas, their number, decoded text) of a run without inner word boundaries."""
        ids = self.ids_of(word)
        known = (",".join(map(str, ids)), len(ids), self.decoded(ids))
        if len(word) <= 64:
            if len(self.cache) >= CACHED:
                self.cache.clear()
            self.cache[word] = known
        return known

    def encode(self, text: str) -> tuple[str, int, str]:
        """(ids joined by commas, their number, decoded text) of a whole text."""
        if not text:
            return "", 0, ""
        marked = SPACE + text.replace(" ", SPACE)
        cache, segment = self.cache, self.segment
        found = [cache.get(w) or segment(w) for w in SEGMENTS.findall(marked)]
        decoded = "".join([f[2] for f in found])
        return ",".join([f[0] for f in found]), sum([f[1] for f in found]), decoded[1:]

    def encode_ids(self, text: str) -> list[int]:
        joined = self.encode(text)[0]
        return [int(i) for i in joined.split(",")] if joined else []


#: No piece goes from inside a word over a blank, so merges never cross these borders.
SEGMENTS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


@lru_cache(maxsize=2)
def vocabulary(model_path: str) -> Vocabulary:
    return Vocabulary(model_path)


def encoded(docs: DataFrame, model_path: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) per row of ``docs``.

    Null text counts as empty and has no tokens. Texts are encoded whole, whatever their length; repeated rows give
    repeated results; an empty table gives none; further columns are ignored. The model file must exist on every
    executor at ``model_path``. One pass, no shuffle.
    """
    extra = ", ids array<int>, decoded string" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(model_path)
        for batch in slices(batches):
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            n, ids_sha, text_sha, all_ids, all_texts = [], [], [], [], []
            for text in texts:
                ids, count, decoded = model.encode(text or "")
                n.append(count)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                if keep_ids:
                    all_ids.append([int(i) for i in ids.split(",")] if ids else [])
                    all_texts.append(decoded)
            columns = [doc_ids, pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)
        # workers go on to other operators' tasks
        model.cache.clear()
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
