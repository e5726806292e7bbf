"""Byte-pair encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array. Each round looks every adjacent pair up by binary
search over the sorted pair keys, finds each word's lowest rank, and merges that pair wherever it
stands in the word. Words without a mergeable pair leave the array, so a round costs what is still open.

A text is cut at ASCII white space first: no special string, no composed character and no pre-token
reaches across it, so the ids of a text are those of its chunks in a row, and each distinct chunk is
encoded once for as long as a worker remembers it.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import WHITE, per_text, with_results

#: A worker forgets its chunks beyond this many, or this many characters of them.
REMEMBERED_CHUNKS, REMEMBERED_CHARS = 400_000, 12_000_000
#: Below this, lower-casing is normalising: the characters have no other canonical form, and every Unicode version classes them alike.
LATIN = "\u0180"
NO_RANK = np.iinfo(np.int32).max
_CHUNK = re.compile(f"[^{WHITE}]+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {b: chr(b) for b in shown}
    for b in range(256):
        chars.setdefault(b, chr(256 + len(chars) - len(shown)))
    return [chars[b] for b in range(256)]


def _latin_pattern(spec: dict):
    """Finds the pre-tokens of lower-case Latin text by the file's own pattern, where its steps are the known ones."""
    norm = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    cut = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    plain = norm == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cut] == ["Split", "ByteLevel"]
    if plain and cut[0]["behavior"] == "Removed" and cut[0]["invert"] and not cut[1]["add_prefix_space"] and not cut[1]["use_regex"]:
        return regex.compile(cut[0]["pattern"]["Regex"]).findall
    return None


class Bpe:
    """A byte-level BPE with word ends, read from a ``tokenizers`` JSON file.

    Normalising and pre-tokenising are the file's own steps, applied by that library to each distinct
    chunk; merging and decoding are done here.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("only plain byte-level BPE files are read")
        if spec["post_processor"] or spec["decoder"]:
            raise ValueError("files with a post-processor or a decoder are not read")
        odd = [t for t in spec["added_tokens"] if t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]]
        if odd:
            raise ValueError(f"added tokens with such flags are not read: {odd}")
        if any(not t["content"] or set(t["content"]) & set(WHITE) for t in spec["added_tokens"]):
            raise ValueError("special strings that are empty or hold white space are not read: texts are cut at it")
        tokenizer = Tokenizer.from_file(path)
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.library_pieces = tokenizer.pre_tokenizer.pre_tokenize_str
        self.latin_pieces = _latin_pattern(spec)
        vocab: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else lambda s: [s]
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.names = np.array([names.get(i, "") for i in range(max(names) + 1)], dtype=object)
        chars = byte_characters()
        self.byte_of = {ord(c): chr(i) for i, c in enumerate(chars)}
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + end] for c in chars], np.int64)
        self.width = int(max(names) + 1)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        # Merging every place of a word's lowest pair at once equals one place after the other
        # if no merge uses a symbol that a later merge makes.
        born = np.full(self.width, -1, np.int64)
        born[made] = np.arange(len(made))
        if len(np.unique(made)) < len(made) or (born[left] >= np.arange(len(made))).any() or (born[right] >= np.arange(len(made))).any():
            raise ValueError("the merges of this file are not in the order in which they were made")

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair among the sorted keys, or -1."""
        want = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, at, -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has. No word is empty."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        if not len(lens):
            return np.zeros(0, np.int64), lens
        codes = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[codes]
        ends = np.cumsum(lens) - 1
        symbols[ends] = self.last[codes[ends]]
        owner = np.repeat(np.arange(len(lens)), lens)
        out_ids: list[np.ndarray] = []
        out_owner: list[np.ndarray] = []
        place = np.full(len(symbols), -1, np.int64)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        place[inside] = self._look_up(symbols[inside], symbols[inside + 1])
        while len(symbols):
            rank = np.where(place >= 0, self.ranks[place], NO_RANK)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            open_ = least < NO_RANK
            if not open_.all():
                keep = np.repeat(open_, sizes)
                out_ids.append(symbols[~keep])
                out_owner.append(owner[~keep])
                symbols, owner, place, rank = symbols[keep], owner[keep], place[keep], rank[keep]
                least, sizes = least[open_], sizes[open_]
                if not len(symbols):
                    break
            chosen = np.flatnonzero(rank == np.repeat(least, sizes))
            # a pair of two equal symbols can overlap itself: take every second of a run
            run = np.r_[True, np.diff(chosen) != 1]
            since = np.arange(len(chosen)) - np.maximum.accumulate(np.where(run, np.arange(len(chosen)), 0))
            chosen = chosen[since % 2 == 0]
            symbols[chosen] = self.made[place[chosen]]
            alive = np.ones(len(symbols), bool)
            alive[chosen + 1] = False
            at = np.cumsum(alive)[chosen] - 1
            symbols, owner, place = symbols[alive], owner[alive], place[alive]
            near = np.zeros(len(symbols), bool)
            near[at] = True
            near[at[at > 0] - 1] = True
            place[near] = -1
            near[-1] = False
            touched = np.flatnonzero(near)
            touched = touched[owner[touched] == owner[touched + 1]]
            place[touched] = self._look_up(symbols[touched], symbols[touched + 1])
        ids, owners = np.concatenate(out_ids), np.concatenate(out_owner)
        order = np.argsort(owners, kind="stable")
        return ids[order], np.bincount(owners, minlength=len(lens))

    def words(self, text: str) -> list[bytes]:
        """The pre-tokens of a text without special strings, in UTF-8."""
        if self.latin_pieces and text.isprintable() and max(text) < LATIN:
            low = text.lower()
            return [low.encode()] if low.isascii() and low.isalpha() else [w.encode() for w in self.latin_pieces(low)]
        return [w.translate(self.byte_of).encode("latin-1") for w, _ in self.library_pieces(self.normalize(text)) if w]

    def pre_tokens(self, chunk: str) -> list[bytes | int]:
        """What a chunk falls into: pre-tokens, and the ids of special strings."""
        parts = self.split_special(chunk)
        if len(parts) == 1:
            return self.words(chunk)
        out: list[bytes | int] = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self.words(part)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Token strings joined by a space, as the library decodes files without a decoder."""
        return " ".join(self.names[ids])


def ragged(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The slices ``values[start:start+len]`` in a row."""
    total = int(lens.sum())
    if not total:
        return values[:0]
    shift = np.repeat(starts - (np.cumsum(lens) - lens), lens)
    return values[np.arange(total) + shift]


class Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        self.new.append(key)
        return n

    def __init__(self):
        super().__init__()
        self.new: list = []

    def taken(self) -> list:
        new, self.new = self.new, []
        return new


class Ragged:
    """Rows of ids that grow at the end."""

    def __init__(self):
        self.ids, self.starts, self.lens = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, lens: np.ndarray) -> None:
        self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(lens) - lens]
        self.lens = np.r_[self.lens, lens]
        self.ids = np.r_[self.ids, ids.astype(np.int32)]

    def at(self, rows: np.ndarray) -> np.ndarray:
        return ragged(self.ids, self.starts[rows], self.lens[rows])


class Encoder:
    """Encodes texts; remembers the ids of a bounded number of chunks and their pre-tokens."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self._forget()

    def _forget(self) -> None:
        self.chunks, self.words, self.chars = Numbered(), Numbered(), 0
        self.chunk_ids, self.word_ids = Ragged(), Ragged()

    def _learn(self, chunks: list[str]) -> None:
        """Adds the ids of new chunks; only pre-tokens never met before are merged."""
        parts = [self.bpe.pre_tokens(c) for c in chunks]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        number = self.words.__getitem__
        at = np.fromiter((number(w) for p in parts for w in p), np.int64, int(counts.sum()))
        new = self.words.taken()
        plain = [w for w in new if not isinstance(w, int)]
        ids, lens = self.bpe.merge(plain)
        if len(plain) < len(new):  # an id stands for itself
            special = np.fromiter((isinstance(w, int) for w in new), bool, len(new))
            all_lens = np.ones(len(new), np.int64)
            all_lens[~special] = lens
            all_ids = np.zeros(int(all_lens.sum()), np.int64)
            own = np.repeat(special, all_lens)
            all_ids[own] = [w for w in new if isinstance(w, int)]
            all_ids[~own] = ids
            ids, lens = all_ids, all_lens
        self.word_ids.add(ids, lens)
        per_part = self.word_ids.lens[at]
        ends = np.r_[0, np.cumsum(per_part)][np.r_[0, np.cumsum(counts)]]
        self.chunk_ids.add(self.word_ids.at(at), np.diff(ends))
        self.chars += sum(map(len, chunks))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        if len(self.chunks) > REMEMBERED_CHUNKS or self.chars > REMEMBERED_CHARS:
            self._forget()
        rows = [_CHUNK.findall(t) for t in texts]
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        at = np.fromiter(map(self.chunks.__getitem__, chain.from_iterable(rows)), np.int64, int(counts.sum()))
        if new := self.chunks.taken():
            self._learn(new)
        ends = np.r_[0, np.cumsum(self.chunk_ids.lens[at])][np.r_[0, np.cumsum(counts)]]
        return self.chunk_ids.at(at), np.diff(ends)


@lru_cache(maxsize=4)
def bpe_from(path: str) -> Bpe:
    return Bpe(path)


@lru_cache(maxsize=4)
def encoder_from(path: str) -> Encoder:
    return Encoder(bpe_from(path))


def _rows(values: np.ndarray, lens: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)], pa.int32()), pa.array(values, pa.int32()))


def _ids_of(path: str):
    return per_text(lambda texts: _rows(*encoder_from(path).encode(texts)), pa.list_(pa.int32()))


def _decoded(bpe: Bpe, ids: np.ndarray, lens: np.ndarray) -> pa.Array:
    ends = np.cumsum(lens)
    return pa.array([" ".join(bpe.names[ids[b - n : b]]) for b, n in zip(ends, lens, strict=True)], pa.string())


def _both_of(path: str):
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def work(texts: list[str]) -> pa.Array:
        ids, lens = encoder_from(path).encode(texts)
        return pa.StructArray.from_arrays([_rows(ids, lens), _decoded(bpe_from(path), ids, lens)], fields=list(kind))

    return per_text(work, kind)


def _text_of(path: str):
    def run(rows: pa.Array) -> pa.Array:
        lens = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        return _decoded(bpe_from(path), rows.flatten().to_numpy(zero_copy_only=False), lens)

    return run


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """Adds ``ids`` (array of int): the tokens of each whole text under the file at ``path``.

    Rows, their order and all other columns stay, repeated rows too; an input column called like the
    result gives way. A null or empty text, or one of white space alone, has no ids. Special strings
    inside a text are tokens, as in the library; no begin or end is added. Texts of any length are
    encoded whole. An empty table gives an empty one.
    """
    column = F.arrow_udf(_ids_of(path), "array<int>")(F.col(f"`{text}`").cast("string"))
    return with_results(docs, {ids: column})


def decode(docs: DataFrame, path: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``decoded`` (string): the text of each row of ids; null or no ids give an empty text. Rows stay, repeated ones too, and an empty table gives an empty one."""
    column = F.arrow_udf(_text_of(path), "string")(F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")))
    return with_results(docs, {decoded: column})


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Adds what :func:`encode` and then :func:`decode` add, in one pass through one worker."""
    both = F.arrow_udf(_both_of(path), "struct<ids: array<int>, decoded: string>")(F.col(f"`{text}`").cast("string"))
    return with_results(docs, {ids: both["ids"], decoded: both["decoded"]})


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded and decoded documents."""
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
