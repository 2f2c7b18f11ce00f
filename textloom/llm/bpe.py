"""BPE encoding and decoding with forced-boundary splitting.

Two adjacent bytes that never occur inside any vocabulary token can never be merged, so a cut
between them is certain. The pairs are read from the vocabulary. A text is cut first wherever such a pair is a
visible character before a blank, which yields words; words that are met for the first time are cut at every other such pair between two
characters, so texts without blanks fall to pieces too. The new pieces of many texts are handed to the library in one call, each as a
string of its own; pieces and words are remembered, and their ids concatenated. A word that occurs a million times is encoded once per worker.

The library splits a text by a pattern before it merges. A cut leaves that as it is: runs of letters, digits or marks that are cut are two
such runs, and the pattern looks no further. Three exceptions are not cut: behind white space (the last blank of several
belongs to what follows), and before and behind an apostrophe (``'s`` and its like are pieces of their own).

The tokenizer file is named by a parameter, read on the driver and sent to the executors (its
size is checked: at most ``MAX_TOKENIZER_BYTES``), so executors need no shared folder for it.

Edge cases: null counts as empty; an empty text has no ids; texts without blanks are cut at absent pairs only; the strings of special tokens inside a text become special tokens, as
in the library's default; equal texts give equal ids; an empty table gives an empty result;
other columns, whatever their names, are ignored by ``bpe_digest``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENIZER_BYTES = 64 << 20
#: Memory bounds of each of a worker's stores; what doesn't fit is encoded anew.
CACHE_ENTRIES = 400_000
CACHE_CHARS = 48
#: Characters of texts that are encoded together (one longer text is taken alone), and ids that are decoded at once.
TOGETHER_CHARS, DECODED_IDS = 1 << 20, 1 << 16


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: the printable character that stands for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


#: White space of any kind, as bytes.
SPACES = tuple(c.encode() for c in map(chr, range(0x10000)) if not 0xD800 <= ord(c) < 0xE000 and c.isspace())


class ForcedBoundaryCodec:
    """A byte-level BPE tokenizer that encodes fragments between forced boundaries."""

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec, alphabet = json.loads(definition), byte_alphabet()
        vocab = dict(self.tokenizer.get_vocab(with_added_tokens=True))
        special = {t["content"] for t in spec.get("added_tokens") or []}
        spelt: list[bytes] = [b""] * (max(vocab.values()) + 1)
        inside: set[tuple[int, int]] = set()
        #: Every token is spelt in the byte alphabet; other vocabularies are left to the library.
        self.by_bytes = all(c in alphabet for t in vocab if t not in special for c in t)
        for token, i in vocab.items():
            raw = token.encode() if token in special or not self.by_bytes else bytes(alphabet[c] for c in token)
            spelt[i] = raw
            inside.update(zip(raw, raw[1:], strict=False))
        #: The bytes of all tokens, and where those of each begin and how many they are.
        self.token_bytes, self.token_size = np.frombuffer(b"".join(spelt), np.uint8), np.array([len(t) for t in spelt], np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        #: Pairs that are cut: the second byte begins a character, and neither is an apostrophe.
        self.absent = frozenset((a, b) for a in range(256) for b in range(256) if (a, b) not in inside and not 0x80 <= b < 0xC0 and 0x27 not in (a, b))
        self.cut_table = np.zeros((256, 256), bool)
        self.cut_table[tuple(np.array(sorted(self.absent), np.int64).reshape(-1, 2).T)] = True
        #: Bytes after which a blank is a forced boundary.
        self.before_blank = [b for b in range(256) if (b, 0x20) not in inside]
        # A visible character ends in an ASCII byte or in a continuation byte. Only classes of
        # characters whose last byte can never precede a blank inside a token may be cut after.
        # \S of Python excludes at least all that the tokenizer's pattern calls white space.
        self.plain, self.high = {chr(b) for b in self.before_blank if 0x20 < b < 0x7F}, all(b in self.before_blank for b in range(0x80, 0xC0))
        blocks = [b for b in spec.get("added_tokens") or [] if " " in b["content"] or b.get("lstrip") or b.get("rstrip") or b.get("single_word")]
        pre = spec.get("pre_tokenizer") or {}
        #: The argument above holds for this kind of tokenizer only; others get whole texts.
        self.exact = self.by_bytes and all(c in vocab for c in alphabet) and not blocks and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        #: Ids of words behind a blank, of words that begin a text, and of pieces.
        self.of_words: dict[str, bytes] = {}
        self.of_heads: dict[str, bytes] = {}
        self.of_pieces: dict[bytes, bytes] = {}

    def _cuts(self, raw: np.ndarray) -> np.ndarray:
        """Where bytes are cut: between an absent pair, but not behind white space."""
        cuts = np.flatnonzero(self.cut_table[raw[:-1], raw[1:]]) + 1
        # The three bytes before a cut as one number: what ends in a white character's bytes ends in that character.
        ahead = np.concatenate([np.zeros(2, np.uint8), raw]).astype(np.int32)
        last = ahead[cuts - 1] << 16 | ahead[cuts] << 8 | ahead[cuts + 1]
        white = np.zeros(len(cuts), bool)
        for c in SPACES:
            white |= last & ((1 << 8 * len(c)) - 1) == int.from_bytes(c)
        return cuts[~white]

    def pieces(self, fragment: str) -> list[str]:
        """A fragment cut at every absent pair."""
        raw = fragment.encode("utf-8", "surrogatepass")
        cuts = self._cuts(np.frombuffer(raw, np.uint8)).tolist()
        return [raw[i:j].decode("utf-8", "surrogatepass") for i, j in zip([0, *cuts], [*cuts, len(raw)], strict=True)]

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece by itself, in one call of the library; whose they are follows from the bytes of their tokens."""
        texts = [p.decode("utf-8", "surrogatepass") for p in pieces]
        ids = np.array(self.tokenizer.encode_batch_fast([texts], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        spelt, wanted = np.cumsum(self.token_size[ids]), np.cumsum([len(p) for p in pieces])
        at = np.searchsorted(spelt, wanted)
        if at[-1] != len(ids) - 1 or (spelt[at] != wanted).any():
            raise RuntimeError("the tokens do not spell the pieces")
        raw, stops = ids.tobytes(), (4 * (at + 1)).tolist()
        return [raw[i:j] for i, j in zip([0, *stops], stops, strict=False)]

    def _encode_fragments(self, fragments: list[str]) -> list[bytes]:
        """Ids of fragments: all are cut at every absent pair, and the pieces that are new are encoded together."""
        raws = [f.encode("utf-8", "surrogatepass") for f in fragments]
        raw, ends = b"".join(raws), np.cumsum(list(map(len, raws)))
        at = np.zeros(len(raw) + 1, bool)
        at[self._cuts(np.frombuffer(raw, np.uint8))] = at[ends] = True
        stops = np.flatnonzero(at)
        own = [raw[i:j] for i, j in zip([0, *stops.tolist()], stops.tolist(), strict=False)]
        coded = list(map(self.of_pieces.get, own))
        if None in coded:
            new = list(dict.fromkeys(p for p, c in zip(own, coded, strict=True) if c is None))
            found = dict(zip(new, self._encode_pieces(new), strict=True))
            coded = [found[p] if c is None else c for p, c in zip(own, coded, strict=True)]
            self._remember(self.of_pieces, {p: ids for p, ids in found.items() if len(p) <= CACHE_CHARS})
        last = (np.searchsorted(stops, ends) + 1).tolist()
        return [coded[i] if j == i + 1 else b"".join(coded[i:j]) for i, j in zip([0, *last], last, strict=False)]

    @staticmethod
    def _remember(store: dict, found: dict) -> None:
        if len(store) + len(found) > CACHE_ENTRIES:
            store.clear()
        store.update(found)

    def _cut_after(self, word: str) -> bool:
        """Whether a blank behind ``word`` begins a fragment."""
        return bool(word) and (word[-1] in self.plain if word[-1] < "\x80" else self.high and not word[-1].isspace())

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.exact:
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if t else b"" for t in texts]
        rows, new = [], {}
        for text in texts:
            # Words at blanks. Only those are remembered behind which a blank begins a fragment, so known ones are fragments.
            words = text.split(" ")
            coded = list(map(self.of_words.get, words))
            coded[0] = self.of_heads.get(words[0]) if text else b""
            gaps, j = [], -1
            coded.append(None)
            while (k := coded.index(None, j + 1)) < len(words):
                j = k
                while j < len(words) - 1 and not self._cut_after(words[j]):
                    j += 1
                fragment = " ".join(words[k : j + 1])
                coded[k : j + 1] = [b""] * (j + 1 - k)
                if k and j > k and fragment in self.of_words:
                    coded[k] = self.of_words[fragment]
                else:
                    gaps.append((k, f" {fragment}" if k else fragment))
            coded.pop()
            rows.append((coded, gaps))
            new.update((f, None) for _, f in gaps)
        new = dict(zip(new, self._encode_fragments(list(new)), strict=True)) if new else {}
        for coded, gaps in rows:
            for k, f in gaps:
                coded[k] = new[f]
        kept = [f for f in new if len(f) <= CACHE_CHARS and self._cut_after(f)]
        self._remember(self.of_words, {f[1:]: new[f] for f in kept if f[0] == " "})
        self._remember(self.of_heads, {f: new[f] for f in kept if f[0] != " "})
        return [b"".join(coded) for coded, _ in rows]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of encoded ids; bytes that are no UTF-8 become replacement characters."""
        if not self.by_bytes:
            return self.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        found, parts = np.frombuffer(ids, "<u4"), []
        for k in range(0, len(found), DECODED_IDS):
            own = found[k : k + DECODED_IDS]
            size = self.token_size[own]
            ends = np.cumsum(size)
            parts.append(self.token_bytes[np.repeat(self.token_start[own] - ends + size, size) + np.arange(ends[-1])].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _codec(definition: str) -> ForcedBoundaryCodec:
    return ForcedBoundaryCodec(definition)


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        definition = f.read()
    if len(definition) > MAX_TOKENIZER_BYTES:
        raise ValueError("the tokenizer file exceeds the size that is sent to executors")
    return definition


def _encoded(codec: ForcedBoundaryCodec, column: pa.Array) -> Iterator[bytes]:
    texts, held = [], 0
    for text in column:
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= TOGETHER_CHARS:
            yield from codec.encode_all(texts)
            texts, held = [], 0
    yield from codec.encode_all(texts)


def _texts(batches: Iterator[pa.RecordBatch], sent, fields: list[str]) -> Iterator[pa.RecordBatch]:
    codec = _codec(sent.value)
    for batch in batches:
        out: dict[str, list] = {f: [] for f in fields}
        for ids in _encoded(codec, batch.column(1)):
            if "ids" in out:
                out["ids"].append(np.frombuffer(ids, "<u4").tolist())
            if "n_tokens" in out:
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(codec.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
        kinds = {"ids": pa.list_(pa.int64()), "n_tokens": pa.int64()}
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()]], names=["id", *fields])


def _run(docs: DataFrame, path: str, id_col: str, text_col: str, fields: dict[str, str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(read_tokenizer(path))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    coded = rows.mapInArrow(lambda batches: _texts(batches, sent, list(fields)), ", ".join(["id long", *[f"{k} {v}" for k, v in fields.items()]]))
    return coded.withColumnRenamed("id", id_col)


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<long>`` for every row."""
    return _run(docs, path, id_col, text_col, {"ids": "array<long>"})


def bpe_decode(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text`` for every row of ids."""
    sent = coded.sparkSession.sparkContext.broadcast(read_tokenizer(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            texts = [codec.decode(np.array(ids or [], "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return coded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)


def bpe_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: encodes, then decodes the ids, keeping digests."""
    return _run(docs, path, id_col, text_col, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"})
