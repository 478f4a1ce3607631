"""Token ids of whole texts, by the tokenizers library.

The vocabulary's pre-tokenizer always breaks at ASCII white space and no added
token holds any, so a text's ids are its words' ids in a row. Each worker
keeps the ids of words it has met; the library encodes every other word.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of words and ids that a worker remembers, about: half of them new ones,
#: half those met before (bounds memory, not results).
KEEP_BYTES = 160 << 20
#: Words remembered at most, in the same halves; ``keep`` sets another number, with
#: as many bytes for each.
KEEP_WORDS = 600_000
#: Words for a job in which tokenizing is nearly all the work, with little else in
#: memory.
KEEP_MANY = 1_600_000
#: Bytes of a text's stretches, and of text whose words are looked up at once: four
#: times as many by who remembers many words, an eighth by others.
GROUP_BYTES = 1 << 20
#: What a remembered word takes besides its bytes.
_OVERHEAD = 200
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Punctuation that never joins the letters before it to one pre-token.
_TAIL = ".,;:!?#$%&*"
#: Longest tail taken off a word; words with longer ones are looked up whole.
_TAIL_MAX = 8


def vocabulary() -> str:
    """Default vocabulary file, of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _stretches(text: bytes):
    """A text in stretches of about GROUP_BYTES, cut at white space; words are
    looked up without the case of A-Z, which the vocabulary ignores."""
    if b"<|" not in text:                       # an added token minds its case
        text = text.lower()
    at = 0
    while len(text) - at > 2 * GROUP_BYTES:
        gap = _GAP.search(text, at + GROUP_BYTES)
        if gap is None:
            break
        yield text[at:gap.start()]
        at = gap.end()
    yield text[at:] if at else text


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, keep: int | None = None):
        self.keep = keep
        # who remembers few words has little memory for a group, too
        self.group = 4 * GROUP_BYTES if (keep or 0) >= KEEP_MANY else GROUP_BYTES // 8
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.letters = self._plain(self.library)
        vocab = self.library.get_vocab()
        self.size = max(vocab.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {b"": b""}
        self.before: dict[bytes, bytes] = {}
        self.held = 0

    @staticmethod
    def _plain(library):
        """The library's own model behind a split at white space: lower-case ASCII
        letters come out of the vocabulary's normalizer and pre-tokenizer as they went
        in, one pre-token a word, so that those need not run on them."""
        from tokenizers import Tokenizer, pre_tokenizers

        plain = Tokenizer(library.model)
        plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        words = "the quick brown fox jumps over a lazy dog xqzj"
        same = plain.encode(words).ids == library.encode(words, add_special_tokens=False).ids
        return plain if same else None               # a vocabulary of another kind

    def ids(self, text: bytes) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text. The words of a group of texts are looked up together,
        so that the library is called once for all the new ones."""
        out: list[list[bytes]] = [[] for _ in texts]
        group, size = [], 0
        for i, text in enumerate(texts):
            for part in _stretches(text):
                group.append((i, part))
                size += len(part)
                if size > self.group:
                    self._look_up(group, out)
                    group, size = [], 0
        self._look_up(group, out)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _look_up(self, group: list[tuple[int, bytes]], out: list[list[bytes]]) -> None:
        words = self.keep or KEEP_WORDS
        size = KEEP_BYTES * max(words / KEEP_WORDS, 1)
        if len(self.known) > words // 2 or self.held > size / 2:
            self.before, self.known, self.held = self.known, {b"": b""}, 0
        # Arrow splits at the same ASCII white space as bytes do, and may leave empty
        # words at the ends; each of a group's words is looked up once
        split = pc.ascii_split_whitespace(
            pa.array([part for _, part in group], pa.large_binary()).cast(pa.large_string()))
        coded = split.values.dictionary_encode()
        packed = self._ids_of(coded.dictionary).take(coded.indices)
        stops = np.frombuffer(packed.buffers()[1], np.int64)[:len(packed) + 1]
        data = memoryview(packed.buffers()[2] or b"")
        stops = stops[split.offsets.to_numpy()].tolist()
        for (i, _), a, b in zip(group, stops, stops[1:]):
            out[i].append(data[a:b].tobytes())

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words. "the," is "the" and ",": words that differ in the
        punctuation behind them alone are looked up as one."""
        stem = pc.ascii_rtrim(words, _TAIL)
        last = pc.utf8_slice_codeunits(stem, -1).dictionary_encode()
        letter = pa.array([x.isalpha() for x in last.dictionary.to_pylist()],
                          pa.bool_()).take(last.indices)
        n = pc.subtract(pc.binary_length(words), pc.binary_length(stem))
        short = pc.and_(pc.greater(n, 0), pc.less_equal(n, _TAIL_MAX))
        # but '",' is one pre-token, and "<|" may begin an added token
        apart = pc.and_not(pc.and_(letter, short), pc.match_substring(words, "<|"))
        stems = pc.if_else(apart, stem, words).dictionary_encode()
        ids = self._remembered(stems.dictionary).take(stems.indices)
        if not pc.any(apart).as_py():
            return ids
        tail = pa.nulls(len(words), pa.large_string())
        for k in pc.unique(n.filter(apart)).to_pylist():
            own = pc.and_(apart, pc.equal(n, k))
            tail = pc.replace_with_mask(
                tail, own, pc.utf8_slice_codeunits(words.filter(own), -k))
        tails = pc.fill_null(tail, "").dictionary_encode()
        return pc.binary_join_element_wise(
            ids, self._remembered(tails.dictionary).take(tails.indices),
            pa.scalar(b"", pa.large_binary()))

    def _remembered(self, words: pa.Array) -> pa.Array:
        """Ids of words, of which the new ones are learnt."""
        own = words.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, own))
        missing = [w for w, found in zip(own, ids) if found is None]
        if missing:
            self._learn(missing)
            learnt = list(map(self.known.get, missing))
            self.held += (len(missing) * _OVERHEAD + sum(map(len, missing))
                          + sum(map(len, learnt)))
            rest = iter(learnt)
            ids = [next(rest) if found is None else found for found in ids]
        return pa.array(ids, pa.large_binary())

    def _library_ids(self, text: str, library=None) -> list[int]:
        # the batch call that leaves out offsets, which nothing here needs
        return (library or self.library).encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _encode(self, words: list[bytes]) -> None:
        """Any words, each by itself: short ones in calls of many."""
        short = [w for w in words if len(w) < 200]
        calls = [short[at:at + 500] for at in range(0, len(short), 500)]
        for some in calls + [[w] for w in words if len(w) >= 200]:
            coded = self.library.encode_batch_fast([w.decode() for w in some],
                                                   add_special_tokens=False)
            self.known.update((w, np.array(x.ids, "<u4").tobytes()) for w, x in zip(some, coded))

    def _learn(self, missing: list[bytes]) -> None:
        known, letters, others, rest = self.known, [], [], []
        for w, found in zip(missing, map(self.before.get, missing)):
            if found is not None:
                known[w] = found
            elif w.isalpha():                    # ASCII letters
                letters.append(w)
            elif len(w) < 200 and w.decode().isalpha():
                others.append(w)
            else:
                rest.append(w)
        # apart, as one other word would send a whole call the long way
        self._learn_letters(letters)
        self._learn_letters(others)
        self._encode(rest)

    def _learn_letters(self, words: list[bytes]) -> None:
        """Words of letters only are one pre-token each, and the last token of
        a pre-token is marked: one call encodes many words."""
        for at in range(0, len(words), 2000):
            some = words[at:at + 2000]
            joined = b" ".join(some)
            plain = joined.isascii() and joined.islower()
            found = np.array(self._library_ids(
                joined.decode(), self.letters if plain else None), "<u4")
            stops = np.flatnonzero(self.ends[found]) + 1
            if len(stops) != len(some) or stops[-1] != len(found):
                self._encode(some)
                continue
            packed, a = found.tobytes(), 0
            for w, b in zip(some, (stops * 4).tolist()):
                self.known[w] = packed[a:b]
                a = b


@lru_cache(maxsize=2)
def word_ids(path: str, keep: int | None = None) -> WordIds:
    """This worker's tokenizer with its remembered words."""
    return WordIds(path, keep)


def forget() -> bool:
    """Drops this worker's tokenizers, if it has any: a worker outlives its tasks, and
    the words it has met are of no use to another operator's."""
    held = word_ids.cache_info().currsize > 0
    word_ids.cache_clear()
    return held
