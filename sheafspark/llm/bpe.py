"""Byte-pair encoding of whole texts in batched numpy merge rounds, and decoding."""

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from sheafspark.llm.arrow_text import byte_column, each, row_slices, white_space_blocks

#: Distinct words whose tokens a task keeps; beyond that it starts over.
KEPT_WORDS = 80_000
#: Bytes of text whose ids and decoded text leave a task at a time.
CODED_BYTES = 4 << 20
_NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class MergeTable:
    """Pairs of symbol ids as sorted keys, with the rank and the result of each."""

    def __init__(self, vocab: dict[str, int], merges: list):
        self.width = max(vocab.values()) + 1
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs] or [-1], np.int64)
        results = np.array([vocab[a + b] for a, b in pairs] or [0], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.results = keys[order], order.astype(np.int64), results[order]

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges many words at once; ``sizes`` has the symbols of each word. Returns tokens and their number by word.

        A round finds the pairs of all words by binary search and merges, in each word, all places of its pair with
        the lowest rank, the leftmost first. Words without a known pair leave the rounds.
        """
        n = len(sizes)
        owner = np.repeat(np.arange(n), sizes)
        done_owner, done_symbols = [], []
        while len(symbols):
            inner = np.empty(len(symbols), bool)
            inner[:-1], inner[-1] = owner[1:] == owner[:-1], False
            keys = np.where(inner, symbols * self.width + np.append(symbols[1:], 0), -2)
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            ranks = np.where(self.keys[at] == keys, self.ranks[at], _NONE)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lengths = np.diff(np.append(starts, len(symbols)))
            lowest = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
            finished = lowest == _NONE
            done_owner.append(owner[finished])
            done_symbols.append(symbols[finished])
            chosen = (ranks == lowest) & ~finished
            # of overlapping places, such as in a run of one symbol, every second one merges
            index = np.arange(len(symbols))
            opens = chosen & ~np.append(False, chosen[:-1])
            chosen &= (index - np.maximum.accumulate(np.where(opens, index, 0))) % 2 == 0
            symbols = np.where(chosen, self.results[at], symbols)
            keep = ~finished & ~np.append(False, chosen[:-1])
            symbols, owner = symbols[keep], owner[keep]
        owner = np.concatenate([*done_owner, np.empty(0, np.int64)]).astype(np.int64)
        tokens = np.concatenate([*done_symbols, np.empty(0, np.int64)]).astype(np.int64)
        return tokens[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=n)


class _Runs:
    """Token lists of different lengths in one flat array."""

    def __init__(self):
        self.ids, self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])

    def of(self, k: int) -> np.ndarray:
        return self.ids[self.starts[k] : self.starts[k] + self.sizes[k]]

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of all entries one after the other, and their sizes."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(total)], sizes


class WordBpe:
    """A vocabulary of lower-cased words with an end-of-word suffix, read from a tokenizer file.

    Words are memoised with their tokens, so each distinct word takes part in merge rounds once for a while.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path = path
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [s["type"] for s in spec["normalizer"]["normalizers"]], [s["type"] for s in steps]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or model["type"] != "BPE":
            raise ValueError(f"{path} is not a word-level BPE file of the known form")
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pieces = regex.compile(steps[0]["pattern"]["Regex"] + "|\n")
        self.table = MergeTable(vocab, model["merges"])
        self.inner = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.last = np.array([vocab[c + suffix] for c in byte_symbols()], np.int64)
        self.library = None
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}  # words
        self.words = _Runs()
        self.index: dict[str, int] = {"\n": 0}  # pieces; a line break ends a word and has no token
        self.parts = _Runs()
        self.parts.add(np.empty(0, np.int32), np.zeros(1, np.int64))
        for content, token in self.special.items():  # no piece is such a string
            self.index[content] = len(self.index)
            self.parts.add(np.array([token], np.int32), np.ones(1, np.int64))

    def _add_pieces(self, pieces: list[str]) -> None:
        """Adds the tokens of new pieces, all in the same merge rounds."""
        new = [p for p in dict.fromkeys(pieces) if p not in self.index]
        coded = [p.encode("utf-8", "surrogateescape") for p in new]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        data = np.frombuffer(b"".join(coded), np.uint8)
        symbols, ends = self.inner[data], np.cumsum(sizes)
        symbols[ends - 1] = self.last[data[ends - 1]]
        self.parts.add(*self.table.merge(symbols, sizes))
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))

    def _odd_pieces(self, text: str) -> list[str]:
        """Pieces of a text with characters whose class or case differs between Unicode versions: the library decides."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
            self.letters = {c: bytes([b]) for b, c in enumerate(byte_symbols())}
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [b"".join(map(self.letters.__getitem__, p)).decode("utf-8", "surrogateescape") for p, _ in found]

    def _plain_pieces(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        return self.pieces.findall(text.replace("Σ", "σ").lower())  # lower() alone has a final sigma

    def _mixed_pieces(self, word: str) -> list[str]:
        """Pieces of a word that may hold special tokens or young characters."""
        pieces = []
        for part in self.split_special.split(word) if self.split_special else [word]:
            if part in self.special:
                pieces.append(part)
            elif part:
                young = any(unicodedata.ucd_3_2_0.category(c) == "Cn" for c in part)
                pieces += self._odd_pieces(part) if young else self._plain_pieces(part)
        return pieces

    def learn(self, words: list[bytes]) -> None:
        """Adds the tokens of new words, which have no ASCII white space inside."""
        text = b"\n".join(words).decode()
        young = [c for c in set(text) if c > "\x7f" and unicodedata.ucd_3_2_0.category(c) == "Cn"]
        odd = []
        if young or (self.split_special and self.split_special.search(text)):
            is_odd = regex.compile("|".join(map(regex.escape, [*young, *self.special])))
            split = [(w, bool(is_odd.search(w.decode()))) for w in words]
            odd = [w for w, x in split if x]
            words = [w for w, x in split if not x]
            text = b"\n".join(words).decode()
        pieces = self._plain_pieces(text) if words else []
        for n, word in enumerate(odd, start=len(words)):
            pieces += ["\n"] * (n > 0) + self._mixed_pieces(word.decode())
        words = words + odd
        self._add_pieces(pieces)
        at = np.array(list(map(self.index.__getitem__, pieces)), np.int64)
        # line breaks stand between words
        ids, sizes = self.parts.gather(at)
        by_word = np.bincount(np.cumsum(at == 0), weights=sizes, minlength=len(words)).astype(np.int64)
        self.words.add(ids, by_word)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))

    def _lookup(self, words: list[bytes]) -> np.ndarray:
        try:
            found = list(map(self.known.__getitem__, words))
        except KeyError:
            if len(self.known) > KEPT_WORDS:
                self.clear()
            self.learn([w for w in dict.fromkeys(words) if w not in self.known])
            found = list(map(self.known.__getitem__, words))
        return np.array(found, np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts in one array, and their number by text."""
        if len(texts) > 1:
            split = [t.split() for t in texts]
            return self._gather([w for words in split for w in words], list(map(len, split)))
        blocks = [self._gather(b.split(), None) for b in white_space_blocks(texts[0])]
        ids = np.concatenate([b[0] for b in blocks])
        return ids, np.array([len(ids)])

    def _gather(self, words: list[bytes], words_by_text: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
        found = self._lookup(words)  # may start the kept words over
        ids, sizes = self.words.gather(found)
        if words_by_text is None:
            return ids, np.array([len(ids)])
        upto = np.cumsum(np.append(0, sizes))[np.cumsum([0, *words_by_text])]
        return ids, np.diff(upto)


def _encoded(bpe: WordBpe, column: pa.Array) -> pa.ListArray:
    column = byte_column(column)
    values, counts = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
    for start, stop in row_slices(column):
        found, sizes = bpe.encode(column.slice(start, stop - start).to_pylist())
        values.append(found)
        counts.append(sizes)
    offsets = np.cumsum(np.concatenate(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))


class TokenStrings:
    """The string of each token id of a tokenizer file."""

    def __init__(self, path: str, skip_special_tokens: bool = False):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.known = {i: s for s, i in spec["model"]["vocab"].items()}
        for token in spec["added_tokens"]:
            self.known[token["id"]] = token["content"]
            if skip_special_tokens and token["special"]:
                del self.known[token["id"]]

    def decode(self, column: pa.ListArray) -> pa.Array:
        """The strings of each list, with one space between; unknown ids have none."""
        known, out = self.known, []
        for row in column:
            tokens = row.values
            if tokens is None:
                out.append(None)
                continue
            tokens = tokens.to_numpy(zero_copy_only=False).tolist()
            try:
                out.append(" ".join(map(known.__getitem__, tokens)))
            except KeyError:
                out.append(" ".join(known[t] for t in tokens if t in known))
        return pa.array(out, pa.string())


def encode(text: Column, tokenizer: str) -> Column:
    """The token ids of each whole text, as the file's own library gives them without added special tokens.

    Null and empty texts have no tokens.
    """

    @F.arrow_udf("array<int>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = WordBpe(tokenizer)
        for column in each(columns):
            yield _encoded(bpe, column)

    return ids(text)


def decode(ids: Column, tokenizer: str, skip_special_tokens: bool = False) -> Column:
    """The text of each list of token ids: their strings, with one space between. Unknown ids have no text.

    Null gives null, an empty list the empty text.
    """

    @F.arrow_udf("string")
    def texts(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        strings = TokenStrings(tokenizer, skip_special_tokens)
        for column in each(columns):
            yield strings.decode(column)

    return texts(ids)


def encode_decode(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (array of int) and ``decoded`` (their text) for every whole text.

    ``tokenizer`` names a file that every executor has. Null texts count as empty: no ids, an empty decoded text.
    Repeated rows are encoded each; an empty table gives an empty table. Columns of the same names are replaced,
    other columns stay.
    """

    own = [c for c in docs.columns if c not in ("ids", "decoded")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.col(f"`{text}`").alias("text"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # both steps in one worker process, and small batches out
        bpe, strings = WordBpe(tokenizer), TokenStrings(tokenizer)
        for batch in each(batches):
            texts = byte_column(batch.column(1))
            for start, stop in row_slices(texts, CODED_BYTES):
                ids = _encoded(bpe, texts.slice(start, stop - start))
                row = batch.column(0).slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([row, ids, strings.decode(ids)], ["row", "ids", "decoded"])

    schema = StructType([rows.schema["row"], StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())])
    return rows.mapInArrow(coded, schema).select(*[F.col("row")[c].alias(c) for c in own], "ids", "decoded")
