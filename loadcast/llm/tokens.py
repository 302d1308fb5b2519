"""Token ids by the tokenizers library, each distinct piece of text encoded once per worker."""

from __future__ import annotations

import os
import unicodedata
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END_ID = 2
# Distinct words a worker remembers, and as many pieces; the older half goes when that many are met.
MEMORY = 700_000
# Texts that are cut together, so that their words are looked up once; a batch is bounded in bytes too.
TEXT_ROWS = 512

# The split patterns of the two vocabularies, fixed values of their files.
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_PLAIN_GAPS = regex.compile(r"\s |\s$| \s|^ ")
_LONE_SPACE = regex.compile(r"(?<=\S) (?=\S)")

# Marks of a text's first word and of a word behind a line feed, in texts cut by Arrow; texts that hold one are cut apart.
_FIRST, _FEED = "\x03", "\x02"
# What keeps a text from being cut at each space and line feed: other white space beside it, or at either end.
_SPACES = r"\s\x0b\x1c-\x1f\x85\p{Z}"
_ODD_GAPS = rf"^[{_SPACES}]|[{_SPACES}]$|[{_SPACES}][{_SPACES}][{_SPACES}]|[{_SPACES}][\t\f\r \x0b\x1c-\x1f\x85\p{{Z}}]|[\t\f\r \x0b\x1c-\x1f\x85\p{{Z}}][{_SPACES}]|[\x01-\x03]"
_MARKS = r"[\x01-\x03]"
# The end of an ASCII word or number before another visible character.
_WORD_END = r"([A-Za-z0-9])([!-/:-@\[-`{-~])"
# The letter that byte-level vocabularies show a space as.
_SPACE = "\u0120"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """``encode(text)`` gives what ``Tokenizer.encode(text, add_special_tokens=False).ids`` gives, as bytes.

    Both vocabularies encode piece by piece, so a text's ids are its pieces' ids in order. :meth:`encode_many` cuts
    texts at single spaces and line feeds in Arrow and looks each distinct word of a batch up once; only words and
    pieces not met before go through the library's model. Texts with other gaps are split into pieces one by one. Texts that hold a special token go through the library as a whole,
    and so does any vocabulary of another make.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.kind = self._kind()
        self.split = regex.compile(WORD_SPLIT if self.kind == "word" else BYTE_SPLIT)

    def _kind(self) -> str:
        """Which of the two makes the vocabulary is, found by its own pre-tokenizer; else ``whole``."""
        import json

        made = json.loads(self.tokenizer.to_str())
        before, pre = made["normalizer"], made["pre_tokenizer"] or {}
        if made["model"]["type"] != "BPE" or made["model"].get("dropout") or made["post_processor"] not in (None,):
            return "whole"
        if before is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            return "byte"
        steps = [p["type"] for p in pre.get("pretokenizers", [])]
        if steps == ["Split", "ByteLevel"] and pre["pretokenizers"][0]["pattern"] == {"Regex": WORD_SPLIT}:
            if [n["type"] for n in (before or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
                return "word"
        return "whole"

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece) or self.old_pieces.get(piece)
        if got is None:
            if piece.isalpha() and piece.isascii():
                shown = piece
            else:
                shown = piece.encode().decode("latin-1").translate(self.letters)
            got = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        self.pieces[piece] = got
        return got

    def _word(self, word: str) -> bytes:
        text = word
        if self.kind == "word":
            text = word.lower() if word.isascii() else self.tokenizer.normalizer.normalize_str(word)
        return b"".join([self._piece(p) for p in self.split.findall(text)])

    def _forget(self) -> None:
        if len(self.words) > MEMORY // 2:
            self.words, self.old_words = {}, self.words
        if len(self.pieces) > MEMORY // 2:
            self.pieces, self.old_pieces = {}, self.pieces

    def _cut(self, text: str) -> list[str]:
        if self.kind == "word":
            return text.replace("\n", " ").split(" ")
        if _PLAIN_GAPS.search(text) is None:
            first, *rest = text.split(" ")
            return [first, *[" " + w for w in rest]]
        cut, at = [], 0
        for gap in _LONE_SPACE.finditer(text):
            cut.append(text[at : gap.start()])
            at = gap.start()
        return [*cut, text[at:]]

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit integers, little-endian as on every machine Spark runs on here."""
        if self.kind == "whole" or any(s in text for s in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if self.kind == "word" and not text.isascii() and unicodedata.normalize("NFC", text) != text:
            text = unicodedata.normalize("NFC", text)
        self._forget()
        return b"".join([self._word(w) for w in self._cut(text)])


    def _learn(self, word: str) -> bytes:
        """Ids of a marked word not met lately, remembered; most are one piece of plain letters."""
        got = self.old_words.get(word)
        if got is None:
            spaced, mark = self.kind == "byte", word[:1]
            body = word[1:] if mark == _FIRST or mark == _FEED else word
            if body.isalpha() and body.isascii():
                shown = body.lower() if not spaced else body if body is not word else _SPACE + body
                got = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
                got = self._piece("\n") + got if mark == _FEED else got
            else:
                got = self._word(body if mark == _FIRST or not spaced else "\n" + body if mark == _FEED else " " + body)
        self.words[word] = got
        return got

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """:meth:`encode` of each text. Texts with plain gaps are cut by Arrow, and each of their words is looked up once."""
        column = pa.array(texts, pa.large_string())
        apart = np.zeros(len(texts), bool)
        if self.kind == "whole":
            apart[:] = True
        else:
            for s in self.special:
                apart |= pc.match_substring(column, s).to_numpy(zero_copy_only=False)
            odd = _ODD_GAPS if self.kind == "byte" else _MARKS
            apart |= pc.match_substring_regex(column, odd).to_numpy(zero_copy_only=False)
            if self.kind == "word":
                apart |= np.fromiter((not t.isascii() and not unicodedata.is_normalized("NFC", t) for t in texts), bool, len(texts))
        out: list[bytes] = [b""] * len(texts)
        for k in np.flatnonzero(apart):
            out[k] = self.encode(texts[k])
        plain = np.flatnonzero(~apart)
        if len(plain):
            for k, ids in zip(plain, self._encode_plain(column.take(pa.array(plain)))):
                out[k] = ids
        return out

    def _encode_plain(self, column: pa.Array) -> list[bytes]:
        self._forget()
        spaced = self.kind == "byte"
        # Pieces end where a letter or digit meets another character, so words are cut there too and repeat more often.
        column = pc.replace_substring_regex(column, _WORD_END, rf"\1 {_FIRST}\2" if spaced else r"\1 \2")
        if spaced:
            column = pc.replace_substring(column, "\n", f" {_FEED}")
            column = pc.binary_join_element_wise(pa.scalar(_FIRST, column.type), column, pa.scalar("", column.type))
        else:
            column = pc.ascii_lower(pc.replace_substring(column, "\n", " "))
        cut = pc.split_pattern(column, " ")
        coded = cut.values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.words.get, words))
        for k in [k for k, got in enumerate(ids) if got is None]:
            ids[k] = self._learn(words[k])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, starts = np.frombuffer(b"".join(ids), np.uint32), np.cumsum(sizes) - sizes
        code = coded.indices.to_numpy()
        size = sizes[code]
        ends = np.cumsum(size)
        data = flat[np.repeat(starts[code] - (ends - size), size) + np.arange(int(ends[-1]))].tobytes()
        cuts = 4 * np.concatenate([[0], ends])[cut.offsets.to_numpy()]
        return [data[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def vocabulary_size(path: str) -> int:
    """Ids of a tokenizer file, all below this number."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab().values()) + 1


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_all(path: str, texts: Iterable[str | None], end_id: int | None = END_ID) -> list[bytes]:
    """Ids of each text, null as empty, with the end id behind them."""
    end = b"" if end_id is None else array("I", [end_id]).tobytes()
    return [ids + end for ids in encoder(path).encode_many([t or "" for t in texts])]
