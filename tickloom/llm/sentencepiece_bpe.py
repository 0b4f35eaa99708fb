"""SentencePiece (BPE, byte fallback) encoding and decoding through a merge-type prefix table.

For a word the table stores, for each prefix, the unique last token of that prefix's BPE encoding.  An Aho-Corasick
automaton names all vocabulary pieces that end at a position; the one that follows the last token of the prefix before
it and is compatible with it (the pair, merged as BPE merges, gives the pair again) is the last token.  The ids are then
recovered backwards from the whole word.  A character that no piece covers becomes its UTF-8 bytes.

The text is first written the way the model's normaliser does (a space as U+2581, one more in front of a text that
isn't empty).  No normal piece holds U+2581 after another character (checked on loading), so no merge crosses the place
before a run of U+2581 and words are encoded on their own.  Pieces made of U+2581 alone share one score, so runs of two
and more of them, where order of merging is by place, are merged with a heap; a word of any other kind uses the table.

Defined results: a null text is the empty text, which has no ids; extra columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterable

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import P, bound_batches

SPACE = "▁"
#: Words kept encoded in a Python worker: two generations of so many, the older of which goes when the younger is full.
CACHE = 80_000
#: Longer words are encoded each time; pairs tested; characters of words whose ids decode to something else.  All bound a worker's memory.
LONGEST, PAIRS, ODD = 48, 200_000, 1_000_000
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5


def _merge(parts: list[str], score: dict[str, float]) -> list[str]:
    """BPE: the adjacent pair whose joined piece scores highest is joined, the leftmost of equals first.

    Pairs wait in a heap and neighbours are linked, so a run of n characters takes n log n steps.
    """
    n = len(parts)
    parts, after, before = list(parts), list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[float, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (s := score.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (-s, i, len(parts[i]) + len(parts[j])))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i]
        if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != size:  # one of the two has been joined meanwhile
            continue
        parts[i], parts[j] = parts[i] + parts[j], ""
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [p for p in parts if p]


class _Made(dict):
    """A dictionary that asks ``make`` for the value of a missing key; ``make`` keeps it or not."""

    def __init__(self, make: Callable) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key):
        return self.make(key)


class Tokenizer:
    """Encoder and decoder of one model file."""

    def __init__(self, model_file: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only BPE models without character normalisation are supported")
        self.prefix = bool(spec.add_dummy_prefix)
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of) or any(p.type == _USER for p in model.pieces):
            raise ValueError("pieces of this model cross words")
        self.score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == _UNKNOWN)
        self.control = {i for i, p in enumerate(model.pieces) if p.type == _CONTROL}
        self.piece = [p.piece for p in model.pieces]
        self.special = {*self.byte_of, *self.control, self.unknown}
        self.machine = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            if len(p) == 1 or _merge(list(p), self.score) == [p]:  # others are never the outcome of merging
                self.machine.add_word(p, len(p) << 20 | i)
        self.machine.make_automaton()
        self.chars = frozenset(p for p in self.id_of if len(p) == 1)
        self.decimal = [str(i).encode() for i in range(len(self.piece))]
        self.shown = [p.replace(SPACE, " ").encode() for p in self.piece]
        self.fits: dict[int, bool] = _Made(self.compatible)
        self.words: dict[str, bytes] = _Made(self._known)
        self.older: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}
        self.odd_size = 0
        # Marks that follow a letter in no piece: no merge crosses the place between, so the letters stand alone.
        marks = {c for p in self.id_of for c in p if not c.isalnum() and c != SPACE and c != "_"}
        marks -= {b for p in self.id_of for a, b in zip(p, p[1:], strict=False) if a.isalpha()}
        held = "".join(map(re.escape, sorted(marks))) + SPACE
        self.word = re.compile(rf"{SPACE}*+[^\W\d_]++(?![^{held}])|{SPACE}*[^{SPACE}]+|{SPACE}+")

    def compatible(self, pair: int) -> bool:
        """Whether merging the joined strings of two pieces (left id << 20 | right id) gives the two again."""
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        two = [self.piece[pair >> 20], self.piece[pair & 0xFFFFF]]
        got = self.fits[pair] = _merge(list("".join(two)), self.score) == two
        return got

    def _table(self, word: str) -> list[int]:
        """Ids of a stretch whose characters all are pieces: the table of last tokens, then read backwards."""
        last = [0] * (len(word) + 1)  # length << 20 | id
        fits, done = self.fits, 0
        for at, found in self.machine.iter(word):  # of the pieces that end at a place, the longest first
            if at >= done:
                start = at + 1 - (found >> 20)
                if start:
                    pair = (last[start] & 0xFFFFF) << 20 | found & 0xFFFFF
                    if not fits[pair]:
                        continue
                done = at + 1
                last[done] = found
        out, at = [], len(word)
        while at:
            found = last[at]
            out.append(found & 0xFFFFF)
            at -= found >> 20
        out.reverse()
        return out

    def _plain(self, word: str) -> bool:
        """Whether the table covers the word: its ids then are pieces that spell it."""
        return self.chars.issuperset(word) and SPACE * 2 not in word

    def _ids(self, word: str) -> list[int]:
        """Ids of a word that the table doesn't cover."""
        ids: list[int] = []
        known = self.id_of
        run: list[str] = []

        def flush() -> None:
            if run:
                s = "".join(run)
                ids.extend([known[p] for p in _merge(list(s), self.score)] if SPACE * 2 in s else self._table(s))
                run.clear()

        for c in word:
            if c in known:
                run.append(c)
            else:
                flush()
                raw = c.encode("utf-8", "surrogatepass")
                ids.extend(self.byte_id[b] for b in raw) if self.byte_id else ids.append(self.unknown)
        flush()
        return ids

    def _normal(self, text: str) -> str:
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE) if text else ""

    def _known(self, word: str) -> bytes:
        """Decimal ids joined by commas.  Where the ids don't decode to the word, ``odd`` has what they decode to."""
        got = self.older.get(word) or self.words.get(word)  # words that came meanwhile: the text holds on to the dictionary that it began with
        if got is None:
            plain = self._plain(word)
            ids = self._table(word) if plain else self._ids(word)
            got = b",".join([self.decimal[i] for i in ids])
            if not plain and (back := self._bytes(ids)) != word.replace(SPACE, " ").encode("utf-8", "surrogatepass"):
                self.odd[word] = back
                self.odd_size += len(word)
        if len(word) <= LONGEST:
            if len(self.words) >= CACHE:
                self.older, self.words = self.words, _Made(self._known)
            self.words[word] = got
        return got

    def _trim(self) -> None:
        """Between texts: forget all when the odd words have grown, since cached words rely on them."""
        if self.odd_size > ODD:
            self.words, self.older, self.odd, self.odd_size = _Made(self._known), {}, {}, 0

    def encode(self, text: str) -> list[int]:
        return [int(x) for w in self.word.findall(self._normal(text)) for x in self._known(w).split(b",")]

    def _bytes(self, ids: Iterable[int]) -> bytes:
        """Bytes of ids; U+2581 of pieces stands for a space."""
        ids = list(ids)
        if not any(i in self.special for i in ids):
            return b"".join([self.shown[i] for i in ids])
        out, run = bytearray(), bytearray()

        def flush() -> None:
            out.extend(_clean(bytes(run)))
            run.clear()

        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            flush()
            if i == self.unknown:
                out.extend(" ⁇ ".encode())
            elif i not in self.control:
                out.extend(self.shown[i])
        flush()
        return bytes(out)

    def decode(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        raw = self._bytes(ids)
        first = next((i for i in ids if i not in self.control), None)
        if self.prefix and first is not None and self.piece[first].startswith(SPACE):
            raw = raw[1:]
        return raw.decode("utf-8")

    def encode_decode(self, text: str) -> tuple[int, bytes, str]:
        """Number of ids, ids as decimals joined by commas, decoded text."""
        parts = self.word.findall(self._normal(text))
        if not parts:
            return 0, b"", ""
        self._trim()
        ids = b",".join(map(self.words.__getitem__, parts))
        if self.odd and not self.odd.keys().isdisjoint(parts):
            raw = b"".join([self.odd[w] if w in self.odd else w.replace(SPACE, " ").encode("utf-8", "surrogatepass") for w in parts]).decode("utf-8")
        else:
            raw = "".join(parts).replace(SPACE, " ")
        first = int(ids[: ids.find(b",")] if b"," in ids else ids)
        if self.prefix and self.piece[first].startswith(SPACE):
            raw = raw[1:]
        return ids.count(b",") + 1, ids, raw


def _clean(run: bytes) -> bytes:
    """Bytes that are no UTF-8 become U+FFFD, each on its own."""
    try:
        run.decode("utf-8")
        return run
    except UnicodeDecodeError:
        out, at = bytearray(), 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    run[at : at + n].decode("utf-8")
                except UnicodeDecodeError:
                    continue
                if len(run[at : at + n]) == n:
                    out.extend(run[at : at + n])
                    at += n
                    break
            else:
                out.extend("�".encode())
                at += 1
        return bytes(out)


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(model_file: str) -> Tokenizer:
    """The tokenizer of ``model_file``, read once in a process."""
    if model_file not in _LOADED:
        _LOADED[model_file] = Tokenizer(model_file)
    return _LOADED[model_file]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, text_col: str = "text", model_file: str | None = None, with_ids: bool = True) -> DataFrame:
    """``docs`` with ``__tl_ids`` (left out on request), ``__tl_n_tokens``, ``__tl_ids_sha256`` and ``__tl_decoded``."""
    bound_batches(docs.sparkSession)
    path = model_file or default_model()
    fields = ["n_tokens long", "ids_sha256 string", "decoded string", *["ids array<int>"] * with_ids]

    @F.pandas_udf(", ".join(fields))
    def run(text: pd.Series) -> pd.DataFrame:
        t, rows = tokenizer(path), []
        for x in text:
            n, ids, back = t.encode_decode(x or "")
            rows.append((n, hashlib.sha256(ids).hexdigest(), back, *[[int(i) for i in ids.split(b",")] if n else []] * with_ids))
        return pd.DataFrame(rows, columns=[f.split()[0] for f in fields])

    done = docs.withColumn(f"{P}sp", run(F.col(text_col)))
    return done.select(*docs.columns, *[F.col(f"{P}sp.{f.split()[0]}").alias(f"{P}{f.split()[0]}") for f in fields])


def query(docs: DataFrame) -> DataFrame:
    d = encode_documents(docs.select("doc_id", "text"), with_ids=False)
    return d.select("doc_id", F.col(f"{P}n_tokens").alias("n_tokens"), F.col(f"{P}ids_sha256").alias("ids_sha256"), F.sha2(F.col(f"{P}decoded").cast("binary"), 256).alias("decoded_sha256"))
