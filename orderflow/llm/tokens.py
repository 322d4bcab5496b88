"""Token ids of whole texts, one encoding per distinct piece of text.

Neither public vocabulary merges across a blank or line break between
two other characters, so a text's ids are the ids of its blank-separated
pieces in order.  A worker keeps the ids of pieces it has seen (bounded)
and asks the tokenizers library only for new ones, those of a group of
texts as one text; the library normalises, cuts and merges them itself.  With a byte-level
vocabulary a run of white space is cut as a whole: a text with a blank
or line break next to other white space is encoded in one call instead.

The ids are those of the vocabulary as loaded, with added tokens: a text
that holds the literal of one (also after lower-casing) is encoded whole,
in one call.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
from contextlib import contextmanager, suppress
from operator import itemgetter

import numpy as np

from .common import worker_cache

#: Pieces a worker remembers (two generations of this many).
CACHE_PIECES = 600_000
#: Longer pieces are not remembered.
CACHE_CHARS = 64
#: Characters of texts looked up together (one text may be longer).
GROUP_CHARS = 1 << 20
#: Marks that a vocabulary always cuts off the letters before them: all of ASCII.
ENDS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: White space other than a blank or line break (as ``str.split`` knows it).
OTHER_SPACE = re.compile(r"[^\S \n]")


@contextmanager
def uncollected():
    """No cyclic garbage collection inside the block: the many small tuples
    and lists of an encoding hold no cycles, and are only walked in vain."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _slices(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The ids as bytes, cut at ``ends``."""
    raw, cuts = ids.tobytes(), (4 * ends).tolist()
    return [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]


class Encoder:
    """Ids of whole texts under one vocabulary file.

    ``pieces`` bounds what is remembered (two generations of so many),
    ``group`` the characters of texts looked up together.
    """

    def __init__(self, path: str, pieces: int = CACHE_PIECES, group: int = GROUP_CHARS):
        self.pieces, self.group = pieces, group
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: Texts of added tokens, which the library finds before it cuts pieces.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: With a normaliser, white space only separates pieces.
        self.drops_space = self.tokenizer.normalizer is not None
        #: Which ids end a word; None if the vocabulary does not mark that.
        self.word_end: np.ndarray | None = None
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            known = self.tokenizer.get_vocab()
            self.word_end = np.zeros(max(known.values()) + 1, bool)
            self.word_end[[i for token, i in known.items() if token.endswith(suffix)]] = True
            #: The same merges for words that the normaliser and the cut at marks leave as they are.
            self.plain = Tokenizer(self.tokenizer.model)
            self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        #: Bytes of text that each id stands for, where the vocabulary's letters are bytes.
        self.byte_sizes: np.ndarray | None = None
        if type(self.tokenizer.decoder).__name__ == "ByteLevel" and not self.drops_space:
            known = self.tokenizer.get_vocab()
            self.byte_sizes = np.zeros(max(known.values()) + 1, np.int64)
            self.byte_sizes[list(known.values())] = list(map(len, known))
        self.young: dict[str, bytes] = {"": b""} if self.drops_space else {}
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (letters only), from one call over all of them that
        keeps no places in the text: where a vocabulary marks the ends of
        words, the ids tell them."""
        pieces = [" " + w for w in words]
        if self.word_end is None:
            return self._encode_pieces(pieces)
        text = "".join(pieces)
        library = self.plain if text.isascii() and text.islower() else self.tokenizer
        ids = np.asarray(library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.word_end[ids]) + 1
        if len(ends) != len(words):  # a word was cut
            return self._encode_pieces(pieces)
        return _slices(ids, ends)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece (with the white space before it, and none else),
        from one call over all of them: a token belongs to the piece that it
        starts in."""
        text = "".join(pieces)
        if any(a in text for a in self.added):  # only across pieces: no piece has one
            return self._encode(pieces)
        if self.byte_sizes is not None:  # the ids tell their places
            ids = np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum(self.byte_sizes[ids])
            sizes = map(len, pieces if text.isascii() else map(str.encode, pieces))
            wanted = np.cumsum(np.fromiter(sizes, np.int64, len(pieces)))
            cuts = np.searchsorted(ends, wanted)
            if cuts[-1] + 1 == len(ids) and (ends[cuts] == wanted).all():
                return _slices(ids, cuts + 1)
        found = self.tokenizer.encode_batch([text], add_special_tokens=False)[0]
        ids = np.asarray(found.ids, "<u4")
        starts = np.fromiter(map(itemgetter(0), found.offsets), np.int64, len(ids))
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        return _slices(ids, np.searchsorted(starts, ends))

    def _letters(self, word: str) -> bool:
        """Whether the vocabulary cuts the word only into letters, also after
        its normaliser (which takes some letters apart, into letter and
        mark; such a mark joins the punctuation that follows)."""
        if word.isascii() or not self.drops_space:
            return word.isalpha()
        return unicodedata.normalize("NFC", word).lower().isalpha()

    def _learn(self, pieces: list[str]) -> None:
        """Make every piece known."""
        young, old = self.young, self.old
        plain: dict[str, None] = {}
        words: dict[str, None] = {}
        others: dict[str, None] = {}
        ended: list[tuple[str, str, str]] = []
        for p in pieces:
            known = old.get(p)
            if known is not None:
                young[p] = known
                continue
            word = p.rstrip(ENDS)
            if not self._letters(word.lstrip("\n")):
                others[p] = None
                continue
            if word != p:  # letters, then one run of marks
                ended.append((p, word, p[len(word):]))
                if word in young or word in old:
                    continue
            (others if word[0] == "\n" else plain if word.isascii() and word.islower() else words)[word] = None
        for some in (plain, words):
            if some:
                young.update(zip(some, self._encode_words(list(some))))
        if others:  # a piece carries the blank or line break before it
            young.update(zip(others, self._encode_pieces([p if p[0] == "\n" else " " + p for p in others])))
        for p, word, marks in ended:
            if marks not in self.marks:
                self.marks[marks] = self._encode([marks])[0]
            if word not in young:
                young[word] = old[word]
            young[p] = young[word] + self.marks[marks]

    def _cut(self, text: str) -> tuple[str, list[str]] | None:
        """First piece and the others; None if only the whole text will do."""
        if any(a in text for a in self.added):
            return None
        if self.drops_space:
            try:  # lower() works letter by letter here, as the vocabulary's own normaliser
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
            if any(a in text for a in self.added):  # the library looks before it lower-cases
                return None
            return "", text.replace("\n", " ").split(" ")
        first, *pieces = text.replace("\n", " \n").split(" ")
        # Runs of white space, at the ends too, or other white space.
        if not first or "" in pieces or "\n" in pieces or OTHER_SPACE.search(text):
            return None
        return first, pieces

    def _group(self, texts: list[str]) -> list[bytes]:
        """Ids of the texts, new pieces of all of them in one call."""
        young = self.young
        rows: list[tuple | None] = []
        unknown: dict[str, None] = {}
        for text in texts:
            row = self._cut(text)
            if row is not None:
                first, pieces = row
                got = list(map(young.get, pieces))
                gaps = []
                with suppress(ValueError):  # index() raises after the last one
                    at = got.index(None)
                    while True:
                        gaps.append(at)
                        at = got.index(None, at + 1)
                new = [pieces[k] for k in gaps]
                unknown.update(dict.fromkeys(new))
                row = first, got, gaps, new
            rows.append(row)
        self._learn(list(unknown))
        alone = iter(self._encode([row[0] if row else text for row, text in zip(rows, texts)
                                   if not row or row[0]]))
        out = []
        for row in rows:
            if row is None:
                out.append(next(alone))
                continue
            first, got, gaps, new = row
            for k, p in zip(gaps, new):
                got[k] = young[p]
            out.append((next(alone) if first else b"") + b"".join(got))
        for p in unknown:
            if len(p) > CACHE_CHARS:
                young.pop(p, None)
        if len(self.marks) > self.pieces:
            self.marks.clear()
        return out

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (None: empty)."""
        out: list[bytes] = [b""] * len(texts)
        held: list[int] = []
        size = 0
        for k, text in enumerate(texts):
            if text:
                held.append(k)
                size += len(text)
            if held and (size > self.group or k + 1 == len(texts)):
                if len(self.young) > self.pieces:
                    self.old, self.young = self.young, {"": b""} if self.drops_space else {}
                with uncollected():
                    for at, found in zip(held, self._group([texts[i] for i in held])):
                        out[at] = found
                held, size = [], 0
        return out


def encoder(path: str, pieces: int = CACHE_PIECES, group: int = GROUP_CHARS) -> Encoder:
    """The worker's encoder; what other stages kept in the worker goes."""
    return worker_cache(f"encoder_{os.path.basename(path)}_{pieces}_{group}", lambda: Encoder(path, pieces, group),
                        alone=True)
