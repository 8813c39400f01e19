"""Token ids of whole texts with public tokenizers, in Arrow batches inside tasks.

Both vocabularies split texts before merging bytes and never merge across a split, so ids of a
text are those of its blank-separated parts in order. Texts are split into numbered distinct parts
with Arrow; parts of ASCII, western European or Russian characters alone are cut further into
numbered distinct words, digits and signs. Each worker remembers the words it has seen (a bounded
number) and their ids as Arrow columns; new ones are only merged by the library's model, many in one
call where a byte that no merge contains can stand between them. Parts with other characters
take the library's whole way, some in one call that is cut at the tokens between them. Ids of
parts and texts are gathered by number. Texts with blanks other than single spaces and line feeds
go through the tokenizer whole where that matters.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from .common import portions

#: Words in a worker's memory; beyond, only those of the texts at hand are kept.
MOST_PARTS = 500_000
#: Words that are merged in one string; longer strings are slower, shorter ones go through the library's own cache.
WORDS_PER_STRING = 64
#: Characters (bytes) of texts that are split at a time.
SPLIT_CHARS = 3_000_000
PARTS_PER_CALL = 2_000
#: Patterns for Arrow: pairs of blanks, blanks that are neither space nor line feed.
_OTHER_BLANKS = r"[ \n]{2}|[\t\x0B-\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Letters whose class, lower case and normal form need no look at their neighbours.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿА-я"
_KNOWN = rf"\A[ \n]?[\x21-\x7E{_LETTERS}]*\z"
#: The patterns of the two vocabularies' files for known characters and single blanks.
_BYTE_WORDS = rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s"
_LOWER_WORDS = rf"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[0-9]|[^\s0-9{_LETTERS}]+"
_CUT = "\x00"  # stands before parts and words; texts that hold it go whole
_MARK = "~"  # one token; stands between parts where blanks leave no token
_CODERS: dict[str, Coder] = {}


class Coder:
    """Ids of texts for one vocabulary file of the tokenizers library.

    ``special``: strings of special tokens in a text are those tokens, as in the library's default; else ordinary text.
    """

    def __init__(self, name: str, special: bool = True):
        # Spark already runs one worker per core; threads of the library would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.encode_special_tokens = not special
        self.model = self.tokenizer.model
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.drops_blanks = name.startswith("word_")
        # Texts that go whole: a special token may stand inside a part.
        self.whole = "|".join([*map(re.escape, names), r"\x00", *([] if self.drops_blanks else [_OTHER_BLANKS])])
        self.words = _LOWER_WORDS if self.drops_blanks else _BYTE_WORDS
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.alphabet = {k: to_bytes.pre_tokenize_str(chr(k))[0][0] for k in [0, 0x0A, *range(0x20, 0x7F), *range(0xC0, 0x100), *range(0x410, 0x450)]}
        by_byte = dict(chain.from_iterable(zip(chr(k).encode(), shown) for k, shown in self.alphabet.items()))
        self.by_byte = "".join(by_byte.get(b, "\ufffe") for b in range(256))
        # Words can be merged together if the byte between them is a token of its own that no other token contains.
        between = self.alphabet[0]
        apart = not self.drops_blanks and [t for t in self.tokenizer.get_vocab(with_added_tokens=False) if between in t] == [between]
        self.between = self.model.token_to_id(between) if apart else None
        self.bare = Tokenizer(self.model)
        self.met = pa.array([], pa.string())
        self.met_ids = _lists([])
        # Tokens that begin a part: with a blank in byte-level vocabularies, the mark before each part in the other.
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.drops_blanks:
            mark = self._ids(_MARK)
            self.begins[mark[0]] = len(mark) == 1
        else:
            for token, k in self.tokenizer.get_vocab().items():
                self.begins[k] = token[0] in "ĠĊ"  # space and line feed in the byte alphabet

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)

    def _together(self, parts: list[str]) -> list[bytes]:
        """Ids of each part; one by one if the tokens between them do not tell the parts apart."""
        ids = self._ids("".join([f"{_MARK} {x} " for x in parts] if self.drops_blanks else parts))
        at = np.flatnonzero(self.begins[ids])
        if len(at) != len(parts) or at[0] != 0:
            half = len(parts) // 2
            return self._together(parts[:half]) + self._together(parts[half:]) if half else [self._ids(parts[0]).tobytes()]
        raw, skip = ids.tobytes(), 2 * self.drops_blanks
        cuts = [*(2 * at).tolist(), len(raw)]
        return [raw[a + skip:b] for a, b in zip(cuts, cuts[1:])]

    def _merged(self, words: list[str]) -> list[bytes]:
        """Ids of words of known characters by the library's model."""
        if self.between is None:
            return [array("H", [t.id for t in self.model.tokenize(x.translate(self.alphabet))]).tobytes() for x in words]
        strings = ["".join([x + _CUT for x in words[k:k + WORDS_PER_STRING]]) for k in range(0, len(words), WORDS_PER_STRING)]
        shown = [codecs.charmap_decode(x.encode(), "strict", self.by_byte)[0] for x in strings]
        ids = np.fromiter(chain.from_iterable([x.ids for x in self.bare.encode_batch_fast(shown, add_special_tokens=False)]), np.uint16)
        raw, ends = ids.tobytes(), (2 * np.flatnonzero(ids == self.between)).tolist()
        return [raw[a:b] for a, b in zip([0, *[e + 2 for e in ends]], ends)]

    def _learned(self, words: pa.Array) -> pa.Array:
        """Ids of words that are new to the worker."""
        names, found = words.to_numpy(zero_copy_only=False).tolist(), {}
        known = pc.match_substring_regex(words, _KNOWN).to_numpy(zero_copy_only=False).tolist()
        simple = [x for x, is_known in zip(names, known) if is_known]
        others = []
        for word, is_known in zip(names, known):
            if is_known:
                continue
            if self.drops_blanks or word[0] in " \n":
                others.append(word)
            else:  # begins a text
                found[word] = self._ids(word).tobytes()
        for some, ids_of in ((simple, self._merged), (others, self._together)):
            for at in range(0, len(some), PARTS_PER_CALL):
                part = some[at:at + PARTS_PER_CALL]
                found.update(zip(part, ids_of(part)))
        return _lists([found[x] for x in names])

    def _ids_of_words(self, words: pa.Array) -> pa.Array:
        words = words.cast(pa.string())
        places = pc.index_in(words, value_set=self.met)
        if places.null_count:
            missing = words.filter(places.is_null())
            at = places.fill_null(-1).to_numpy().copy()
            at[at < 0] = len(self.met) + np.arange(places.null_count, dtype=at.dtype)
            places = pa.array(at)
            self.met_ids = pa.concat_arrays([self.met_ids, self._learned(missing)])
            self.met = pa.concat_arrays([self.met, missing])
        ids = self.met_ids.take(places)
        if len(self.met) > MOST_PARTS:
            self.met, self.met_ids = words, ids
        return ids

    def _ids_of_parts(self, parts: pa.Array) -> pa.Array:
        plain = pc.utf8_lower(parts) if self.drops_blanks else parts
        words = pc.replace_substring_regex(plain, self.words, _CUT + r"\0")
        words = pc.if_else(pc.match_substring_regex(parts, _KNOWN), words, parts)
        return _gathered(pc.split_pattern(words, _CUT), self._ids_of_words)

    def _encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        whole = pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~whole))
        if self.drops_blanks:
            split = pc.split_pattern(pc.replace_substring(plain, "\n", " "), " ")
        else:  # each part keeps the blank before it
            split = pc.split_pattern(pc.replace_substring(pc.replace_substring(plain, " ", _CUT + " "), "\n", _CUT + "\n"), _CUT)
        found = _gathered(split, self._ids_of_parts)
        ids, until, place = found.values.to_numpy(), found.offsets.to_numpy(), 0
        for row, alone in enumerate(whole.tolist()):
            if alone:
                yield self._ids(texts[row].as_py())
            else:
                yield ids[until[place]:until[place + 1]]
                place += 1

    def encode(self, texts: list[str] | pa.Array) -> Iterator[np.ndarray]:
        """Ids (16 bits each) of each text in turn; only some texts are split at a time."""
        rows = pa.record_batch([pa.array(texts, pa.string()) if isinstance(texts, list) else texts], ["text"])
        for some in portions([rows], "text", SPLIT_CHARS):
            yield from self._encode(some["text"])


def _lists(raw: list[bytes]) -> pa.Array:
    """Lists of 16-bit ids from their bytes."""
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 2
    return pa.LargeListArray.from_arrays(np.append(0, np.cumsum(sizes)), pa.array(np.frombuffer(b"".join(raw), np.uint16)))


def _gathered(split: pa.Array, ids_of: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """Ids of each list of strings; ``ids_of`` gives those of the distinct strings, each list has one at least."""
    numbered = split.flatten().dictionary_encode()
    ids = ids_of(numbered.dictionary)
    sizes = pc.list_value_length(ids).to_numpy()[numbered.indices.to_numpy()]
    ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(pc.list_value_length(split).to_numpy()))]
    return pa.LargeListArray.from_arrays(ends, ids.take(numbered.indices).flatten())


def coder(name: str) -> Coder:
    """The worker's coder for a vocabulary, built once."""
    if name not in _CODERS:
        _CODERS[name] = Coder(name)
    return _CODERS[name]
