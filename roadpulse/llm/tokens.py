"""Exact token ids of public tokenizers, with the ids of pieces between spaces remembered.

Both tokenizer files split a text before a space that a visible character follows, and nothing
crosses that place: their ids of a text are those of the pieces, joined. So every piece is
encoded once while it is remembered, and a text costs one look-up per piece.

The file that drops white space also splits at tabs and line ends and lower-cases. There Arrow
finds the distinct pieces of a batch, cuts the punctuation behind their words and lower-cases A-Z,
and only distinct words are looked up.
"""

import os
import re
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from roadpulse.llm.common import kept

#: Words that an encoder remembers, and a quarter as many other pieces: about 300 MB.
REMEMBERED = 1_000_000
_LONG = 64
_SPACE = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?!\S)")
_LETTERS = r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u0148\u014A-\u024F]+)"
_MARKS = r"([!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~]*)"
_MARK = frozenset("!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~")
#: Letters with punctuation behind them, and perhaps the same again on the next line. An
#: apostrophe is left out: with the letters after it, it can be one piece.
_PLAIN = re.compile(f"{_LETTERS}{_MARKS}(?:\n{_LETTERS}{_MARKS})?")
_WORD = re.compile(_LETTERS)
#: How byte-level vocabularies write the bytes that are not written as themselves; spaces stay.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_WRITTEN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN) if b != 0x20}


class PieceEncoder:
    """ids of texts as ``tokenizers`` gives them without added special tokens."""

    def __init__(self, name: str, keeps_spaces: bool, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keeps_spaces, self.remembered = keeps_spaces, remembered
        if not keeps_spaces:
            # the same merges for plain words in lower case, which the rest of the file leaves alone
            self.merges = Tokenizer(self.tokenizer.model)
            self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.edges = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that begin (or end) a word
        for token, i in vocabulary.items():
            self.edges[i] = token.startswith("\u0120") if keeps_spaces else token.endswith("</w>")
        self.words: dict[str, bytes] = {}  # plain words and what they are put together with
        self.known: dict[str, bytes] = {}  # all pieces of late, words included

    def _pieces(self, text: str) -> list[str]:
        parts = _SPACE.split(text) if _ODD.search(text) else text.split(" ")
        parts[0] = "\0" + parts[0]  # the first piece has no space before it
        return parts

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode(self, pieces: list[str]) -> list[bytes]:
        if self.keeps_spaces:
            pieces = [p[1:] if p[:1] == "\0" else " " + p for p in pieces]
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """ids of plain words, encoded as one text and cut at its words.

        They have a space before each, or their A-Z in lower case.
        """
        joined, tokenizer = " ".join(words), self.tokenizer
        if self.keeps_spaces:
            joined = " " + joined
        else:
            tokenizer = self.merges
            if not joined.isascii():
                joined = joined.lower().encode().decode("latin-1").translate(_WRITTEN)
        ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.flatnonzero(self.edges[ids])
        cuts = (cuts if self.keeps_spaces else np.concatenate([[0], cuts + 1])).tolist()
        whole = ids.tobytes()
        return [whole[4 * i : 4 * j] for i, j in zip(cuts, [*cuts[1:], len(ids)])]

    def _learn_words(self, new: list[str]) -> list[tuple[str, bytes]]:
        """Add plain words to the known ones."""
        found = []
        for i in range(0, len(new), 2_000):
            some = new[i : i + 2_000]
            found += zip(some, self._encode_words(some))
        self.words.update(found)
        return found

    def _learn(self, pieces: set[str]) -> list[str]:
        """Add new pieces to the known ones; returns those that hardly come again.

        Pieces made of plain words and punctuation are put together from the ids of these.
        """
        known, words, made = self.known, self.words, []
        new, others, passing = set(), [], []
        inner = "\0"  # begins a part without a space before it
        for p in pieces:
            if p.isascii() and len(p) <= _LONG:
                # the common cases of the pattern: a word, or a word and one mark
                if p.isalpha():
                    if p not in words:
                        new.add(p)
                    continue
                head, mark = p[:-1], p[-1:]
                if mark in _MARK and head.isalpha():
                    if head not in words:
                        new.add(head)
                    made.append((p, [head, inner + mark]))
                    continue
            m = _PLAIN.fullmatch(p) if len(p) <= _LONG else None
            if not m:
                others.append(p)
                passing.append(p)
                continue
            first, tail, second, end = m.groups()
            if first not in words:
                new.add(first)
            if tail or second:
                parts = [first]
                if tail:
                    parts.append(inner + tail)
                if second:
                    parts += [inner + "\n", inner + second]
                    if end:
                        parts.append(inner + end)
                    passing.append(p)
                made.append((p, parts))
        small = {x for _, parts in made for x in parts[1:] if x not in words}
        known.update(self._learn_words(list(new)))
        small = list(small)
        words.update(zip(small, self._encode(small)))
        known.update(zip(others, self._encode(others)))
        for p, parts in made:
            known[p] = b"".join([words[x] for x in parts])
        for p in pieces.difference(known):
            known[p] = words[p]
        return passing

    def _folded(self, texts: list[str]) -> list[np.ndarray]:
        """ids of texts by the file that drops white space and lower-cases."""
        words = self.words
        words[""] = b""  # the word of a piece of punctuation only
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary
        cut = pc.ascii_rtrim(pieces, characters="".join(_MARK))
        heads = pc.ascii_lower(cut).dictionary_encode()
        names = heads.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(words.get, names))
        new = [k for k, ids in enumerate(found) if ids is None and len(names[k]) <= _LONG and _WORD.fullmatch(names[k])]
        new.sort(key=lambda k: names[k].isascii())
        for k, (_, ids) in zip(new, self._learn_words([names[k] for k in new])):
            found[k] = ids
        own = [found[k] for k in heads.indices.to_numpy().tolist()]
        ends = pc.utf8_length(cut).to_numpy()
        tailed = np.flatnonzero(ends != pc.utf8_length(pieces).to_numpy())
        tails = [p[n:] for p, n in zip(pieces.take(pa.array(tailed)).to_numpy(zero_copy_only=False).tolist(), ends[tailed].tolist())]
        marks = [t for t in set(tails) if t not in words]
        words.update(zip(marks, self._encode(marks)))
        for k, tail in zip(tailed.tolist(), tails):
            if own[k] is not None:
                own[k] += words[tail]
        for tail in marks:
            if len(tail) > _LONG:
                del words[tail]
        others = [k for k, ids in enumerate(own) if ids is None]
        for k, ids in zip(others, self._encode(pieces.take(pa.array(others, pa.int64())).to_pylist())):
            own[k] = ids
        numbers, starts = coded.indices.to_numpy(), split.offsets.to_numpy().tolist()
        return [np.frombuffer(b"".join([own[k] for k in numbers[i:j].tolist()]), np.uint32) for i, j in zip(starts, starts[1:])]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """One array of ids per text."""
        if len(self.words) > self.remembered:
            self.words.clear()
            self.known.clear()
        if len(self.known) > len(self.words) + self.remembered // 4:
            self.known.clear()
            self.known.update(self.words)
        if not self.keeps_spaces:
            out = [self._whole(t) if any(s in t for s in self.special) else None for t in texts]
            rest = [i for i, ids in enumerate(out) if ids is None]
            for i, ids in zip(rest, self._folded([texts[i] for i in rest])):
                out[i] = ids
            return out
        known = self.known
        split = [None if any(s in t for s in self.special) or "\0" in t else self._pieces(t) for t in texts]
        passing = self._learn(set().union(*filter(None, split)).difference(known))
        out = []
        for text, parts in zip(texts, split):
            if parts is None:
                out.append(self._whole(text))
            else:
                out.append(np.frombuffer(b"".join(map(known.__getitem__, parts)), np.uint32))
        for p in passing:
            del known[p]
        return out


def encoder(name: str, keeps_spaces: bool, remembered: int = REMEMBERED) -> PieceEncoder:
    """The encoder of this Python worker, which the stage's later tasks find again."""
    return kept(("encoder", name, keeps_spaces, remembered), lambda: PieceEncoder(name, keeps_spaces, remembered))
