"""BPE encoding by depth-first traversal of a trie of distinct words, and decoding.

Every prefix of a word has one encoding, and that encoding is the encoding of a shorter
prefix plus one last token. So a trie node needs only its last token: the token that
ends there and may follow the last token of the node where it starts. Walking the trie
depth-first computes that once per node, however many words share the prefix. A token
pair may stand side by side when merging their characters anew yields the same pair;
such answers are remembered. A node also knows where its last token starts; the ids of a
word are read off once, backwards from its end. The trie is never built: sorted words are
its depth-first order, so the walk keeps one path, cut back to what the next word shares, and
a word of any length takes two numbers a character.

The tokenizer file (JSON: BPE with word-end suffix, byte-level characters, lower case,
white space dropped) is a parameter; its text goes to the executors inside the task
closure (1.7 MB for the production file). Characters newer than Python's own Unicode
tables are normalised and split by the tokenizers library, whose tables may know them.

Defined results: a null or blank text has no tokens and decodes to the empty string.
Strings of the file's special tokens in a text become those tokens, as in the
tokenizers library. Rows are encoded one by one; ids, ties and repeated rows are passed
through. Other columns of the input are not read.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.tables import python_tasks

#: Distinct stretches a task remembers between batches; beyond it the older half goes.
REMEMBERED_PIECES = 150_000
#: The same for their characters.
REMEMBERED_CHARACTERS = 20_000_000
#: Texts are gathered to about so many characters before they are encoded: more words share more prefixes.
CHARACTERS_AT_ONCE = 1_500_000

_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_CHUNK = regex.compile(f"[^{_SPACE}]+")
_CONTROL_SPACE = regex.compile("[\x1c-\x1f]")  # blank for str.split, not for the tokenizer


def byte_characters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the
    characters from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(extra)) for b in range(256)]


class TrieBPE:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.spec, self.library = spec, None
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): r
                     for r, m in enumerate(model["merges"])}
        names = {i: t for t, i in chain(self.vocab.items(), self.special.items())}
        self.names = [names.get(i) for i in range(max(names) + 1)]
        self.raw = [i.to_bytes(4, "little") for i in range(len(self.names))]
        self.alphabet = byte_characters()
        split = next(p["pattern"]["Regex"] for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split.replace(r"\s", _SPACE), regex.V1)
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.tokens: dict = {}  # a trie of the vocabulary; "" holds a token's id, "$$" that of its word-end form
        for token, i in self.vocab.items():
            ends = bool(self.end) and token.endswith(self.end) and len(token) > len(self.end)
            node = self.tokens
            for c in token[: -len(self.end)] if ends else token:
                node = node.setdefault(c, {})
            node["$$" if ends or not self.end else ""] = i
            if not self.end:
                node[""] = i
        self.alone: dict[int, bool] = {}
        self.spines: dict[int, tuple[list, list]] = {}
        self.pairs: dict[int, bool] = {}
        self.remembered: dict[str, bytes] = {}
        self.held = 0  # characters of the remembered stretches

    # -- judging tokens and token pairs by the merge ranks
    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def steps(self, token: str) -> tuple[list[tuple[str, int]], list[tuple[str, int]]] | None:
        """How merging builds ``token`` from its characters: its left and right edge, from the
        whole token down to one character, each with the rank of the merge that absorbs
        it (for the whole token: no rank). None if merging does not end in ``token``."""
        parts = self.symbols(token)
        endless = len(self.rank)
        left, right = [(parts[0], endless)], [(parts[-1], endless)]
        while len(parts) > 1:
            ranks = [self.rank.get(p, endless) for p in zip(parts, parts[1:])]
            r = min(ranks)
            if r == endless:
                return None
            i = ranks.index(r)
            parts[i: i + 2] = [parts[i] + parts[i + 1]]
            if i == 0:
                left[0] = (left[0][0], r)
                left.insert(0, (parts[0], endless))
            if i == len(parts) - 1:
                right[0] = (right[0][0], r)
                right.insert(0, (parts[-1], endless))
        return left, right

    def stands_alone(self, i: int) -> bool:
        known = self.alone.get(i)
        if known is None:
            edges = self.steps(self.names[i])
            known = self.alone[i] = edges is not None
            if edges:
                self.spines[i] = edges
        return known

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the boundary between two tokens survives merging: no edge of ``a`` and edge
        of ``b`` may merge before one of them is absorbed inside its own token (at equal
        rank the left pair goes first)."""
        key = a * len(self.names) + b
        known = self.pairs.get(key)
        if known is None:
            rank = self.rank
            known = True
            for y, y_gone in self.spines[b][0]:
                for x, x_gone in self.spines[a][1]:
                    r = rank.get((x, y))
                    if r is not None and r < x_gone and r <= y_gone:
                        known = False
            self.pairs[key] = known
        return known

    # -- the trie
    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        """Ids (little-endian unsigned 32-bit) of each word, written in byte characters."""
        alone, pairs, width, tokens, raw = self.alone, self.pairs, len(self.names), self.tokens, self.raw
        stands_alone, may_follow = self.stands_alone, self.may_follow
        order = sorted(words)
        out: dict[str, bytes] = {}
        # by depth on the current path: last token and its start; on the part that the next word shares, also the
        # vocabulary nodes that end there
        last, begin = array("i", [-1]), array("i", [0])
        open_at: list[list[tuple[int, dict]]] = [[]]
        shared = 0
        for no, word in enumerate(order):
            end = len(word) - 1
            after = order[no + 1] if no + 1 < len(order) else ""
            common, most = 0, min(end, len(after))
            while common < most and word[common] == after[common]:
                common += 1
            here = open_at[shared]
            for depth in range(shared, end + 1):
                char = word[depth]
                here = [(start, place[char]) for start, place in here if char in place]
                if char in tokens:
                    here.append((depth, tokens[char]))
                form = "$$" if depth == end else ""
                for start, place in here:
                    i = place.get(form)
                    if i is not None and (alone[i] if i in alone else stands_alone(i)):
                        if start == 0:
                            break
                        before = last[start]
                        known = pairs.get(before * width + i)
                        if known if known is not None else may_follow(before, i):
                            break
                else:
                    raise ValueError("the vocabulary does not cover this word")
                if depth < end:
                    last.append(i)
                    begin.append(start)
                    if depth < common:
                        open_at.append(here)
            if start:
                ids = [raw[i]]
                while start:
                    ids.append(raw[last[start]])
                    start = begin[start]
                ids.reverse()
                out[word] = b"".join(ids)
            else:
                out[word] = raw[i]
            shared = common
            del last[shared + 1:], begin[shared + 1:], open_at[shared + 1:]
        return out

    # -- texts
    def chunk_pieces(self, chunk: str) -> list[str | int]:
        """Byte-character words of one blank-free stretch of text; a special token is its id."""
        out: list[str | int] = []
        at = 0
        if self.specials is not None and self.specials.search(chunk):
            for m in self.specials.finditer(chunk):
                out += self._plain(chunk[at: m.start()])
                out.append(self.special[m[0]])
                at = m.end()
        return out + self._plain(chunk[at:])

    def _plain(self, part: str) -> list[str]:
        if part.isascii() and part.isprintable():  # printable ASCII bytes stand for themselves
            part = part.lower()
            if part.isalpha():
                return [part]
            return self.pieces.findall(part)
        if not part.isprintable() and any(unicodedata.category(c) == "Cn" for c in part):
            return self._unknown_to_python(part)
        part = unicodedata.normalize("NFC", part)
        part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
        alphabet = self.alphabet
        return ["".join([alphabet[b] for b in piece.encode("utf-8", "surrogatepass")])
                for piece in self.pieces.findall(part)]

    def _unknown_to_python(self, part: str) -> list[str]:
        if self.library is None:
            self.library = tokenizers.Tokenizer.from_str(self.spec)
        split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
        return [piece for piece, _ in split]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        chunks = [(_CHUNK.findall(t) if _CONTROL_SPACE.search(t) else t.split()) if t else [] for t in texts]
        gc.disable()  # nothing here holds cycles; collecting amid its growth only costs time
        known = self.remembered
        fresh = set().union(*chunks).difference(known)
        if fresh:
            parts = {c: self.chunk_pieces(c) for c in fresh}
            pieces = {p for ps in parts.values() for p in ps if isinstance(p, str)}
            # a plain word that is remembered as a stretch of its own need not be walked again
            coded = {p: known[p] for p in pieces.intersection(known) if self.is_plain(p)}
            coded.update(self.encode_words(pieces.difference(coded)))
            for c, ps in parts.items():
                known[c] = (coded[ps[0]] if len(ps) == 1 and isinstance(ps[0], str) else b"".join(
                    [coded[p] if isinstance(p, str) else p.to_bytes(4, "little") for p in ps]))
            self.held += sum(map(len, fresh))
        encoded = [b"".join([known[c] for c in cs]) for cs in chunks]
        if len(known) > REMEMBERED_PIECES or self.held > REMEMBERED_CHARACTERS:
            self.forget()
        gc.enable()
        return encoded

    def rest(self) -> None:
        """Forget all stretches: a worker that waits for other work holds none."""
        self.remembered, self.held = {}, 0

    def is_plain(self, piece: str) -> bool:
        """Whether the piece, taken as a stretch of text, is that one piece."""
        return piece.isascii() and piece.isalpha() and piece.islower() and not (
            self.specials is not None and self.specials.search(piece))

    def forget(self) -> None:
        """Drop the older half of what is remembered, or more until its characters fit."""
        known = self.remembered
        half = len(known) // 2
        for no, chunk in enumerate(list(known)):
            if no >= half and self.held <= REMEMBERED_CHARACTERS // 2:
                break
            self.held -= len(chunk)
            del known[chunk]

    def decode(self, ids: bytes) -> str:
        """Token strings joined by one blank (the file names no decoder); unknown ids are skipped."""
        names = self.names
        numbers = np.frombuffer(ids, dtype="<u4")
        if len(numbers) and int(numbers.max()) >= len(names):
            numbers = numbers[numbers < len(names)]
        got = [names[i] for i in numbers.tolist()]
        return " ".join(got) if None not in got else " ".join([t for t in got if t is not None])


_encoders: dict[str, TrieBPE] = {}


def encoder(spec: str) -> TrieBPE:
    """One encoder per worker process and tokenizer file."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = TrieBPE(spec)
    return _encoders[key]


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:  # a file of the driver: the tokenizer's own, never data
        return f.read()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts of consecutive batches, gathered to ``CHARACTERS_AT_ONCE``."""
    ids: list[pa.Array] = []
    texts: list[str | None] = []
    size = 0
    for b in batches:
        ids.append(b.column(0))
        new = b.column(1).to_pylist()
        texts += new
        size += sum(len(t) for t in new if t)
        if size >= CHARACTERS_AT_ONCE:
            yield pa.concat_arrays(ids), texts
            ids, texts, size = [], [], 0
    if ids:
        yield pa.concat_arrays(ids), texts


def bpe_encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (array of int) for every row. A map over rows: no shuffle."""
    python_tasks(docs.sparkSession)
    spec = _read(tokenizer_path)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(spec)
        for doc_ids, texts in _gathered(batches):
            raw = bpe.encode_batch(texts)
            lengths = np.array([len(x) // 4 for x in raw], dtype=np.int64)
            tokens = pa.array(np.frombuffer(b"".join(raw), dtype="<u4").astype(np.int32))
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), tokens)
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(lengths), ids], names=["doc_id", "n_tokens", "ids"])
        bpe.rest()

    return named.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def bpe_decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
               ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from ``ids``; null ids decode to the empty string."""
    python_tasks(encoded.sparkSession)
    spec = _read(tokenizer_path)
    named = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(spec)
        for b in batches:
            texts = [bpe.decode(np.array(x or [], dtype="<u4").tobytes()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return named.mapInArrow(run, "doc_id long, text string")


def bpe_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Encode, decode, and keep counts and digests only: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``. Ids and decoded texts never leave the worker."""
    python_tasks(docs.sparkSession)
    spec = _read(tokenizer_path)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(spec)
        for doc_ids, texts in _gathered(batches):
            ids = bpe.encode_batch(texts)
            yield pa.RecordBatch.from_arrays([
                doc_ids, pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids]),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.rest()

    return named.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
