"""Token ids of whole texts by the tokenizers library, with a bounded memory of words.

The tokenizer of ``word_bpe_49k.json`` drops white space and never merges across it, so that the ids of a
text are the ids of its words in a row.  Words repeat far more often than texts, hence each worker remembers
the ids of the words it has met.  A word of plain letters, digits and signs is cut into the pieces of the
pre-tokenizer and each piece goes to the library's BPE model; any other word (combining marks, special
tokens, odd white space, other scripts) goes through the library's whole encode().
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

# The contractions of the tokenizer's own split pattern.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_LETTER = "a-zß-öø-ÿ"
# The normalizer, the pre-tokenizer and the rest that this module's rules stand for.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": CONTRACTIONS + "|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "decoder": None,
}
#: Words for which NFC is the identity, lower() acts on single characters and no special token can occur.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PIECE = re.compile(f"{CONTRACTIONS}|[{_LETTER}]+|[0-9]|[^{_LETTER}0-9]+")
#: Characters that str.split() takes for white space and the tokenizer does not.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


def check_rules(spec: dict) -> None:
    """An error, if a tokenizer file has other rules than those that words are cut by here."""
    model, added = spec["model"], spec["added_tokens"]
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    whole = all(t["content"].startswith("<|") and not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]) for t in added)
    if any(spec.get(k) != v for k, v in RULES.items()) or model["type"] != "BPE" or not plain or not whole:
        raise ValueError("the tokenizer file has a normalizer, pre-tokenizer, model or added tokens of another kind")


def byte_chars() -> list[str]:
    """The printable character that byte-level BPE writes for each byte: itself if visible, else the next free one from 256."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(free)) for b in range(256)]


BYTE_TABLE = dict(enumerate(byte_chars()))


def to_byte_chars(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(BYTE_TABLE)


class Remembered(dict):
    """A memo of a function of strings in two generations: at most about 2 * limit entries, recent ones survive.

    Strings of more than ``longest`` characters are not kept.
    """

    def __init__(self, function, limit: int, longest: int = 64):
        super().__init__()
        self.function, self.limit, self.longest, self.old = function, limit, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.function(key)
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def words_of(text: str) -> list[str]:
    """Cut at white space, where the tokenizer always cuts."""
    if any(s in text for s in SEPARATORS):
        return [w for w in text.split(" ") if w]
    return text.split()


class WordIds:
    def __init__(self, path: str, words: int = 250_000, pieces: int = 400_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            check_rules(json.load(f))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.pieces = Remembered(self._piece, pieces)
        self.words = Remembered(self._word, words)

    def _piece(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(to_byte_chars(piece))]).tobytes()

    def _word(self, word: str) -> bytes:
        if "<|" in word or not PLAIN.fullmatch(word):
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return b"".join([self.pieces[p] for p in PIECE.findall(word.lower())])

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit little-endian integers."""
        return b"".join(map(self.words.__getitem__, words_of(text)))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=1)
def encoder(path: str, words: int = 250_000) -> WordIds:
    """One for each worker process; it is kept from task to task."""
    return WordIds(path, words, words * 8 // 5)
