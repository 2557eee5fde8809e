"""Token ids through the tokenizers library, each distinct piece of plain text encoded once per worker.

A tokenizer cuts a text into pieces and encodes every piece on its own. Pieces
never reach across the borders used here, so a text's ids are its words' ids one
after another, and words repeat. ``SpacedEncoder`` serves byte-level vocabularies,
where a word carries the space before it; texts with other white space than single
spaces and line feeds between words are encoded whole. ``FoldedEncoder`` serves
vocabularies that drop white space. Both give the ids of
``tokenizer.encode(text, add_special_tokens=False)``. The tokenizer takes the strings
of its added tokens out of a text before all else, so texts with one are encoded whole;
with ``literal`` strings of special tokens count as ordinary text instead.
"""

from __future__ import annotations

import json
import re
from struct import pack

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

# Distinct pieces of a generation, of which a worker keeps two.
MAX_WORDS = 500_000


class Words(dict):
    """Word -> its ids as little-endian unsigned 32-bit integers.

    When the table is full it becomes the older generation, and words met again move
    back from there, so frequent words are encoded once and memory stays bounded.
    """

    def __init__(self, encode, limit: int = MAX_WORDS):
        super().__init__()
        self.encode, self.limit, self.older = encode, limit, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        self[word] = ids
        return ids


# Letters and printable characters that every Unicode version classes alike, and that stay as they are in NFC.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
PLAIN = re.compile(f"[!-~{LETTERS}]+").fullmatch
# Plain words one space or line feed apart; and such text with no marks but a comma or point behind a word.
PLAIN_TEXT = re.compile(f"[!-~{LETTERS}]++(?:[ \n][!-~{LETTERS}]++)*+").fullmatch
PROSE = re.compile(f"[0-9{LETTERS}]++[.,]?+(?:[ \n][0-9{LETTERS}]++[.,]?+)*+").fullmatch
ENDINGS = "'(?:s|t|re|ve|m|ll|d)"


class Encoder:
    #: The pre-tokenizer's pieces of plain text with single white space, as Python's re states them.
    plain_pieces: re.Pattern

    def __init__(self, definition: str, literal: bool = True):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = literal
        self.normalizer, self.cut, self.model = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        self.model._resize_cache(0)  # words are kept here; the model's own cache would only cost time
        bytewise = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {ord(c): bytewise.pre_tokenize_str(c)[0][0] for c in map(chr, range(128))}
        # byte-level spelling of the bytes that make up characters above ASCII
        for c in map(chr, range(0xC0, 0x180)):
            for byte, letter in zip(c.encode(), bytewise.pre_tokenize_str(c)[0][0], strict=True):
                self.spelled[byte] = letter
        self.plain_ids = Words(self._plain)
        self.pieces = Words(self._piece, MAX_WORDS // 8)  # of text that is not plain
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if not (literal and t.special)]
        self.added = [t.content for t in added if not t.normalized]
        self.added_normal = [self._normal(t.content) for t in added if t.normalized]

    def _normal(self, text: str) -> str:
        return text if self.normalizer is None else self.normalizer.normalize_str(text)

    def _holds_added(self, text: str) -> bool:
        """Whether the tokenizer takes an added token out of the text."""
        for content in self.added:
            if content in text:
                return True
        if self.added_normal:
            text = self._normal(text)
            return any(content in text for content in self.added_normal)
        return False

    def _piece(self, piece: str) -> bytes:
        ids = [token.id for token in self.model.tokenize(piece)]
        return pack(f"<{len(ids)}I", *ids)

    def _spell(self, piece: str) -> str:
        if piece.isascii():
            return piece.replace(" ", self.spelled[32]).replace("\n", self.spelled[10])
        return piece.encode().decode("latin-1").translate(self.spelled)

    def word(self, word: str, lead: str = "") -> bytes:
        """Ids of a word, with the space that leads it if the vocabulary keeps spaces."""
        if PLAIN(word):
            return self.plain_text(lead + self.plain(word))
        return self.part(lead + word)

    def _plain(self, part: str) -> bytes:
        """Ids of a piece, or of a part of plain text that is several."""
        found = self.plain_pieces.findall(part)
        return self._piece(self._spell(part)) if len(found) == 1 else self._joined(found)

    def _joined(self, parts: list[str]) -> bytes:
        return b"".join(map(self.plain_ids.__getitem__, parts))

    def plain_text(self, text: str) -> bytes:
        return self._joined(self.prose(text) if PROSE(text) else self.plain_pieces.findall(text))

    def prose(self, text: str) -> list[str]:
        """Parts of a text that ``PROSE`` matches, cut where pieces end; faster than the pattern of pieces."""
        raise NotImplementedError

    def plain(self, word: str) -> str:
        return word

    def part(self, text: str) -> bytes:
        """Ids of a stretch of text that begins and ends at borders."""
        return b"".join([self.pieces[piece] for piece, _ in self.cut.pre_tokenize_str(self._normal(text))])

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)


class SpacedEncoder(Encoder):
    plain_pieces = re.compile(f"{ENDINGS}| ?[{LETTERS}]+| ?[0-9]+| ?[^\\s0-9{LETTERS}]+|\n")

    def __init__(self, definition: str, literal: bool = True):
        super().__init__(definition, literal)
        self.later = Words(lambda word: self.word(word, " "), MAX_WORDS // 4)
        self.line_feed = self.whole("\n")

    def prose(self, text: str) -> list[str]:
        for mark, cut in ((" ", "\0 "), (".", "\0."), (",", "\0,"), ("\n", "\0\n\0")):
            text = text.replace(mark, cut)
        return text.split("\0")

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._holds_added(text):
            return self.whole(text)
        if PLAIN_TEXT(text):
            return self.plain_text(text)
        if " ".join(text.split()) != text.replace("\n", " "):
            return self.whole(text)
        out = []
        for line in text.split("\n"):
            first, *later = line.split(" ")
            out.append(self.line_feed)
            out.append(self.word(first))
            out += map(self.later.__getitem__, later)
        return b"".join(out[1:])


class FoldedEncoder(Encoder):
    plain_pieces = re.compile(f"{ENDINGS}|[{LETTERS}]+|[0-9]|[^\\s0-9{LETTERS}]+")

    def __init__(self, definition: str, literal: bool = True):
        super().__init__(definition, literal)
        self.known = Words(self.word, MAX_WORDS // 4)

    def plain(self, word: str) -> str:
        return word.lower()

    def prose(self, text: str) -> list[str]:
        return text.replace("\n", " ").replace(".", " .").replace(",", " ,").split(" ")

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._holds_added(text):
            return self.whole(text)
        if PLAIN_TEXT(text):
            return self.plain_text(self.plain(text))
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))


_ENCODERS: dict[tuple[int, bool], Encoder] = {}


def encoder(definition: str, literal: bool = True) -> Encoder:
    """The worker's encoder for a tokenizer definition (the text of its JSON file)."""
    key = hash(definition), literal
    if key not in _ENCODERS:
        cut = json.loads(definition)["pre_tokenizer"]
        spaced = cut["type"] == "ByteLevel"
        _ENCODERS[key] = (SpacedEncoder if spaced else FoldedEncoder)(definition, literal)
    return _ENCODERS[key]


def definition_of(path: str) -> str:
    """A tokenizer file's text, to be sent along with tasks (a few MB, whatever the input)."""
    with open(path, encoding="utf-8") as source:
        return source.read()
