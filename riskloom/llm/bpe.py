"""Byte-pair encoding and decoding with a published word-level vocabulary, by prefix-sharing tries.

Each task gathers the distinct words of a run of documents and walks their trie depth-first (sorted words are that walk; the stack is the
path from the root). A node's state is the last token of the encoding of its prefix: the one vocabulary entry that ends the
prefix and may follow the state it leaves behind. Words with a common beginning share those states, so a shared prefix is encoded once. A word's
encoding is read back from its leaf. Two tokens may be neighbours when merging their joined characters by rank gives the two back.

Defined results: a null or empty text has no tokens and decodes to the empty text; special tokens written in a text become their ids; repeated rows
repeat their result; other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from riskloom.llm.common import narrow, spans

TRIE_BYTES = 4 << 20  # documents whose words share one trie
CACHE_WORDS = 300_000  # encodings a worker remembers; all are forgotten when there are more
CACHE_PAIRS = 1_000_000

# fixed values: white space in the vocabulary's patterns; letters and numbers younger than its character tables; small letters older Pythons lack
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_YOUNGER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB "
    "11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 "
    "191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 "
    "1E6FE-1E6FF 2B73A-2B73F 2B81E-2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F "
)
_NEW_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
                 **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}


def _word_pattern() -> regex.Pattern:
    """Contractions, runs of letters, single numbers, runs of anything else; the library's patterns in terms of this one's tables."""
    young = "".join("-".join(f"\\U{int(x, 16):08X}" for x in r.split("-")) for r in _YOUNGER.split())
    letter, number = rf"[\p{{L}}--[{young}]]", rf"[\p{{N}}--[{young}]]"
    return regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|[[^{_SPACE}\p{{L}}\p{{N}}][{young}]]+")


_WORD = _word_pattern()
_WORD_ASCII = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\t-\r A-Za-z0-9]+")
_LATE = regex.compile("[\u1c89-\U0010ffff]")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Vocabulary, merges, and the encodings of words seen lately."""

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.ranks = {tuple(m): r for r, m in enumerate(model["merges"])}
        self.inner = {t for t in self.ids if not t.endswith(self.end)}
        self.final = {t[: -len(self.end)] for t in self.ids if t.endswith(self.end) and len(t) > len(self.end)}
        self.longest = max(map(len, self.inner | self.final))
        self.letters = _byte_letters()
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self.words: dict[str, tuple[int, ...]] = {s: (i,) for s, i in self.special.items()}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, parts: list[str]) -> list[str]:
        """Symbols merged by rank until none of the pairs has one."""
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _symbols(self, token: str, final: bool) -> list[str]:
        return [*token[:-1], token[-1] + self.end] if final else list(token)

    def follows(self, left: str, token: str, final: bool) -> bool:
        """May ``token`` stand after ``left`` (or, with ``left`` empty, begin a word)?"""
        key = (left, token + self.end if final else token)
        known = self.pairs.get(key)
        if known is None:
            known = self.merged([*left, *self._symbols(token, final)]) == [x for x in key if x]
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _last(self, word: str, upto: int, path: list[str], final: bool) -> str:
        """State of the prefix ``word[:upto]``; ``path`` has the states of all shorter prefixes, path[0] the empty one."""
        known = self.final if final else self.inner
        for start in range(max(0, upto - self.longest), upto):
            token = word[start:upto]
            if token in known and self.follows(path[start], token, final):
                return token
        raise ValueError(f"no token ends {word[:upto]!r}")

    def learn(self, words: set[str]) -> None:
        """Encode words not seen before by one walk over their trie."""
        spelled = sorted(("".join(self.letters[b] for b in w.encode("utf-8")), w) for w in words)
        path, before = [""], ""
        for letters, word in spelled:
            shared, most = 0, min(len(path) - 1, len(letters) - 1, len(before))
            while shared < most and letters[shared] == before[shared]:
                shared += 1
            del path[shared + 1:]
            for upto in range(shared + 1, len(letters)):
                path.append(self._last(letters, upto, path, False))
            token, at = self._last(letters, len(letters), path, True), len(letters)
            out = [self.ids[token + self.end]]
            at -= len(token)
            while at:
                out.append(self.ids[path[at]])
                at -= len(path[at])
            self.words[word] = tuple(reversed(out))
            before = letters

    def words_of(self, text: str) -> list[str]:
        """Normalised words of a text; special tokens stand for themselves."""
        if "<|" in text:
            pieces = self.split.split(text)
            return list(chain.from_iterable([p] if i % 2 else self._plain(p) for i, p in enumerate(pieces)))
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if text.isascii():
            return _WORD_ASCII.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # letters are lowered one by one: no special sigma at word ends
        return _WORD.findall(text.translate(_NEW_CAPITALS) if _LATE.search(text) else text)

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """Token ids of each text; the texts share a trie."""
        split = [self.words_of(t) for t in texts]
        wanted = set().union(*split) if split else set()
        if len(self.words) > CACHE_WORDS:
            self.words = {s: (i,) for s, i in self.special.items()}
        self.learn(wanted - self.words.keys())
        for words in split:
            yield list(chain.from_iterable(map(self.words.__getitem__, words)))

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.names.__getitem__, ids))


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """doc_id, ids (array of int) and, unless switched off, decoded (the text that the ids give back).

    ``path`` is the vocabulary file on every executor.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _tokenizer(path)
        for batch in batches:
            texts = batch.column("text")
            for start, stop in spans(pc.binary_length(texts).to_pylist(), TRIE_BYTES):
                ids = list(bpe.encode_all(texts.slice(start, stop - start).to_pylist()))
                columns = [batch.column("doc_id").slice(start, stop - start), pa.array(ids, pa.list_(pa.int32()))]
                if decode:
                    columns.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    rows = narrow(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>" + ", decoded string" * decode)

