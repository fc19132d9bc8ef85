"""Token counts of a lower-casing word BPE vocabulary, by merging whole batches of words at once.

Pre-tokens are kept as one ragged numpy array of symbols. In each round every pre-token that still has a mergeable pair
applies its lowest-ranked one, at all its places together; pre-tokens without such a pair leave the array, and the number
of their symbols is their count. Pre-tokens met before are not merged again.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sft_tables.llm.common import give_back, read_table, slices, word_hashes

SPACE, LETTER, NUMBER, OTHER, UNKNOWN = 0, 1, 2, 3, 4
#: The rules that the vocabulary file must state, and the endings that stay with their apostrophe.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")
WORD_END = "</w>"
#: No pair.
NONE = np.int32(2**31 - 1)
#: Characters worked on at once, symbols from which on a pre-token is merged by lists of places, and counts kept by a worker. Speed only.
PIECE, LONG, CACHED = 1 << 20, 2048, 1_000_000
#: Code points that lower-casing treats by their surroundings or gives more than one character for.
CONTEXT = re.compile("[Σİ]")


def byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself where it is printable Latin-1, else the next free one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    shown = {b: chr(b) for b in plain}
    return [shown.get(b) or chr(next(other)) for b in range(256)]


class Vocabulary:
    """Merge ranks of a vocabulary file, its word rules, and the counts of words met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        normal = [(s["type"], s.get("pattern", {}).get("Regex"), s.get("content")) for s in spec["normalizer"]["normalizers"]]
        fits = (
            model["type"] == "BPE" and model["end_of_word_suffix"] == WORD_END and not model["continuing_subword_prefix"]
            and not model["ignore_merges"] and not model["dropout"]
            and normal == [("NFC", None, None), ("Replace", r"\s+", " "), ("Lowercase", None, None)]
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"]["Regex"] == SPLIT and steps[0]["invert"] and steps[0]["behavior"] == "Removed"
            and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
            and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        )
        if not fits:
            raise ValueError("a lower-casing BPE vocabulary with word ends is needed")
        ids = model["vocab"]
        if max(ids.values()) >= 1 << 16:
            raise ValueError("ids need more than 16 bits")
        marks = byte_characters()
        self.symbol = np.array([[ids[m] for m in marks], [ids[m + WORD_END] for m in marks]], np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right = (np.array([ids[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.product = np.array([ids[a + b] for a, b in pairs], np.int32)
        keys = (left << 16 | right).astype(np.uint32)
        # a pair that is listed twice counts with its later rank, as in a map filled in order
        order = np.lexsort((-np.arange(len(keys)), keys))
        order = order[np.concatenate([[True], keys[order][1:] != keys[order][:-1]])] if len(order) else order
        self.keys, self.rank_of = keys[order], order.astype(np.int32)
        # merges whose product takes part in a merge of lower rank: these are applied one place at a time
        first_use = np.full(1 << 16, NONE, np.int64)
        for side in (left, right):
            np.minimum.at(first_use, side, np.arange(len(pairs)))
        self.late = first_use[self.product] < np.arange(len(pairs))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.path, self.library = path, None
        self.classes = np.full(0x110000, OTHER, np.uint8)
        category = unicodedata.category
        for c in range(0x110000):
            kind = category(chr(c))
            if kind[0] == "L":
                self.classes[c] = LETTER
            elif kind[0] == "N":
                self.classes[c] = NUMBER
            elif kind == "Cn":
                self.classes[c] = UNKNOWN
            elif kind[0] == "Z" or 9 <= c <= 13 or c == 0x85:
                self.classes[c] = SPACE
        self.assigned = self.classes != UNKNOWN
        self.known, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def own(self):
        """The library's rules, for characters that this Python does not know and texts that are not composed."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return self.library

    def normal(self, text: str) -> str:
        """Composed and lower-cased; white space stays as it is, as it only separates."""
        if text.isascii():
            return text.lower()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if CONTEXT.search(text) or not unicodedata.is_normalized("NFC", text) or not self.assigned[points].all():
            return self.own().normalizer.normalize_str(text)
        return text.lower()

    def class_of(self, points: np.ndarray) -> np.ndarray:
        found = self.classes[points]
        if (found == UNKNOWN).any():
            for c in np.unique(points[found == UNKNOWN]).tolist():
                shown = [s for s, _ in self.own().pre_tokenizer.pre_tokenize_str(f"a{chr(c)}{chr(c)}!")]
                self.classes[c] = NUMBER if len(shown) == 4 else LETTER if len(shown[0]) > 1 else OTHER
            found = self.classes[points]
        return found

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """UTF-8 bytes of a normal text; its pre-tokens' first bytes and the bytes after them, and their first characters."""
        data = np.frombuffer(text.encode(), np.uint8)
        points = data if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self.class_of(points)
        before = np.concatenate([[np.uint8(SPACE)], kind[:-1]])
        start = (kind != SPACE) & ((kind != before) | (kind == NUMBER))
        mark = np.flatnonzero(start & (points == 39))
        if len(mark):
            ahead = np.concatenate([points, np.zeros(2, points.dtype)])
            one, two = ahead[mark + 1], ahead[mark + 2]
            length = np.where(np.isin(one, [ord(c) for c in ONE_LETTER]), 2, 0)
            for a, b in TWO_LETTERS:
                length[(one == ord(a)) & (two == ord(b))] = 3
            mark, length = mark[length > 0], length[length > 0]
            start[mark + 1] = False
            rest = mark + length
            rest = rest[rest < len(points)]
            start[rest[kind[rest] == LETTER]] = True
        edge = np.flatnonzero(start | (kind == SPACE))
        opens = start[edge]
        first, after = edge[opens], np.append(edge, len(points))[1:][opens]
        if data is points:
            return data, first, after, first
        at = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF), out=at[1:])
        return data, at[first], at[after], first

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == keys, self.rank_of[at], NONE) if len(self.keys) else np.full(len(keys), NONE)

    def merged(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Symbols left of each sequence of a ragged array, when its lowest-ranked pair is merged until there is none."""
        left, symbols = lengths.copy(), symbols.copy()
        ids, owner = np.arange(len(lengths)), np.repeat(np.arange(len(lengths)), lengths)
        rank = np.full(len(symbols), NONE, np.int32)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside] = self.ranks(symbols[inside], symbols[inside + 1])
        while len(ids):
            first = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(rank, first)
            live = lowest < NONE
            if not live.all():
                left[ids[~live]] = lengths[~live]
                keep = np.repeat(live, lengths)
                symbols, rank = symbols[keep], rank[keep]
                ids, lengths, lowest = ids[live], lengths[live], lowest[live]
                if not len(ids):
                    break
            owner = np.repeat(np.arange(len(ids)), lengths)
            at = np.flatnonzero(rank == lowest[owner])
            at = self.apart(at, owner[at], rank[at])
            symbols[at] = self.product[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            lengths = lengths - np.bincount(owner[at], minlength=len(ids))
            at = at - np.arange(len(at))  # every merge before it takes one place
            symbols, rank, owner = symbols[keep], rank[keep], owner[keep]
            touched = np.concatenate([at, at[at > 0] - 1])
            ahead = np.minimum(touched + 1, len(symbols) - 1)
            rank[touched] = np.where((touched + 1 < len(symbols)) & (owner[touched] == owner[ahead]), self.ranks(symbols[touched], symbols[ahead]), NONE)
        return left

    def apart(self, at: np.ndarray, owner: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Places of pairs that do not overlap, from the left; of late merges only a sequence's first."""
        fresh = np.concatenate([[True], np.diff(at) != 1]) if len(at) else np.zeros(0, bool)
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0)) if len(at) else at
        keep = (np.arange(len(at)) - run) % 2 == 0
        late = self.late[rank]
        if late.any():
            keep &= ~late | np.concatenate([[True], owner[1:] != owner[:-1]])
        return at[keep]

    def merged_long(self, symbols: np.ndarray) -> int:
        """The same for one long sequence: places are listed by rank, so that a round costs what it merges."""
        n = len(symbols)
        symbols = symbols.copy()
        following, preceding = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.full(n, NONE, np.int32)
        rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def file(places: np.ndarray) -> None:
            places = places[rank[places] < NONE]
            order = np.argsort(rank[places], kind="stable")
            places = places[order]
            if not len(places):
                return
            cuts = np.flatnonzero(np.diff(rank[places])) + 1
            for part in np.split(places, cuts):
                r = int(rank[part[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(part)

        file(np.arange(n - 1))
        left = n
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if self.late[r]:
                if len(at) > 1:
                    waiting[r] = [at[1:]]
                    heapq.heappush(heap, r)
                at = at[:1]
            else:
                # a run of one symbol: pairs from the left
                fresh = np.concatenate([[True], following[at[:-1]] != at[1:]])
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            gone = following[at]
            symbols[at] = self.product[r]
            rank[gone] = NONE
            following[at] = following[gone]
            behind = following[at]
            inner = behind < n
            preceding[behind[inner]] = at[inner]
            left -= len(at)
            before = preceding[at]
            touched = np.unique(np.concatenate([at, before[before >= 0]]))
            ahead = following[touched]
            rank[touched] = np.where(ahead < n, self.ranks(symbols[touched], symbols[np.minimum(ahead, n - 1)]), NONE)
            file(touched)
        return left

    def new_counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        raw = data[np.repeat(starts - first, lengths) + np.arange(lengths.sum())]
        final = np.zeros(len(raw), np.int8)
        final[first + lengths - 1] = 1
        symbols = self.symbol[final, raw]
        long = lengths > LONG
        if not long.any():
            return self.merged(symbols, lengths)
        out = np.zeros(len(lengths), np.int64)
        out[~long] = self.merged(symbols[np.repeat(~long, lengths)], lengths[~long])
        for i in np.flatnonzero(long):
            out[i] = self.merged_long(symbols[first[i]:first[i] + lengths[i]])
        return out

    def counted(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; special strings inside are a token each."""
        pieces, of, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = [text]
            if self.special is not None and "<|" in text:
                parts = self.special.split(text)
                extra[i] = len(parts) - 1
            for part in parts:
                for piece in chunks(part):
                    pieces.append(self.normal(piece))
                    of.append(i)
        if not pieces:
            return extra
        bounds = np.cumsum([len(p) + 1 for p in pieces])
        data, starts, ends, first = self.words("\n".join(pieces))
        if not len(starts):
            return extra
        keys, shown, each = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, keys)
        met = at < len(self.known)
        met[met] = self.known[at[met]] == keys[met]
        counts = np.zeros(len(keys), np.int64)
        counts[met] = self.counts[at[met]]
        if not met.all():
            new = ~met
            counts[new] = self.new_counts(data, starts[shown[new]], ends[shown[new]])
            if len(self.known) > CACHED:
                self.known, self.counts = keys[new], counts[new]
            else:
                self.known, self.counts = np.insert(self.known, at[new], keys[new]), np.insert(self.counts, at[new], counts[new])
        piece = np.searchsorted(bounds, first, "right")
        return extra + np.bincount(np.array(of)[piece], counts[each], len(texts)).astype(np.int64)


def chunks(text: str, most: int = PIECE) -> Iterator[str]:
    """A text in parts that begin with a blank, so that no word is cut."""
    start = 0
    while len(text) - start > most:
        cut = BLANK.search(text, start + most)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


BLANK = re.compile(r"[ \t\n]")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``: tokens of its whole text by the vocabulary file at
    ``path``, which must exist there on every executor. No tokens are added; special strings inside texts are one token.

    Null and empty texts have no bytes and no tokens; texts are counted whole, whatever their length, a megabyte of
    characters at a time; bytes that are no UTF-8 count as U+FFFD. Repeated rows give repeated results, null ids stay, an
    empty table gives no rows, further columns are ignored. One pass, no shuffle. Words met before are recognised by 64
    bits of a hash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in slices(batches):
            raw = batch.column(1).cast(pa.large_binary()).to_pylist()
            counts = known.counted([(t or b"").decode("utf-8", "replace") for t in raw])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t or b"") for t in raw], pa.int64()), pa.array(counts, pa.int64()), pa.array(counts > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])
        # workers go on to other operators' tasks
        known.known, known.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
