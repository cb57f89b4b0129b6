"""Token ids of whole texts by a public tokenizer, word by word from a table that each worker keeps."""

from __future__ import annotations

import array
import os
import unicodedata

from wayfare.llm.worker import kept

# a run of these after letters is a token of its own; not the apostrophe, which may go with letters
MARKS = '!"#$%&()*+,-./:;<=>?@[]^_`{|}~'
# stands between parts that are encoded in one go: a control character with an id of its own, rare in texts
BETWEEN = "\x7f"


class WordIds:
    """Ids of texts by a ``tokenizers`` file whose tokens never span white space, as with word_bpe_49k.

    Then a text's ids are those of its words one after another. Words of letters with marks behind are two
    parts, and case does not matter, so each distinct part is encoded once. Ids are little-endian unsigned
    32-bit bytes. The table of words and parts is emptied at ``most_words``, or at ``most_chars`` where words are
    long, which bounds memory and changes no result.
    """

    def __init__(self, path: str, most_words: int = 1_000_000, most_chars: int = 16_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # its own table of words is of no use beside those here, as it is asked for new parts only
        self.tokenizer.model._resize_cache(0)
        self.between = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        self.most_words = most_words
        self.most_chars = most_chars
        self.words: dict[str, bytes] = {"": b""}
        self.chars = 0

    def encode(self, text: str | None) -> bytes:
        words = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        if len(self.words) > self.most_words or self.chars > self.most_chars:
            self.words, self.chars = {"": b""}, 0
        new = set(words).difference(self.words)
        if new:
            self._learn(new)
        return b"".join(map(self.words.__getitem__, words))

    def _learn(self, words: set[str]) -> None:
        table, split, new = self.words, [], set()
        for word in words:
            stem = word.rstrip(MARKS)
            small = stem.lower()
            # a capital sigma has two small letters; a letter that is normalised to one with a mark in it,
            # as the dotted capital I, goes with the marks behind
            if small != word and stem.isalpha() and "\u03a3" not in stem and (
                small.isascii() or unicodedata.normalize("NFC", small).isalpha()
            ):
                split.append((word, small, word[len(stem):]))
            else:
                new.add(word)
        new.update(p for parts in split for p in parts[1:] if p not in table)
        new = list(new)
        table.update(zip(new, self._ids_of(new)))
        self.chars += sum(map(len, new))
        for word, first, second in split:
            table[word] = table[first] + table[second]
            self.chars += len(word)

    def _ids_of(self, parts: list[str]) -> list[bytes]:
        """Ids of each of ``parts``, taken from those of one text of them all if its parts can be told apart."""
        if len(parts) > 1 and len(self.between) == 1:
            whole = self.tokenizer.encode_batch_fast([f" {BETWEEN} ".join(parts)], add_special_tokens=False)[0].ids
            # each separator gives its id once, so at this number no part gives it
            if whole.count(self.between[0]) == len(parts) - 1:
                ids, out, at = array.array("I", whole).tobytes(), [], 0
                for _ in parts[1:]:
                    end = whole.index(self.between[0], at)
                    out.append(ids[4 * at:4 * end])
                    at = end + 1
                return [*out, ids[4 * at:]]
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [array.array("I", f.ids).tobytes() for f in found]


def word_ids(path: str) -> WordIds:
    """The worker's own table for the tokenizer at ``path``."""
    return kept(("words", path), lambda: WordIds(path))
