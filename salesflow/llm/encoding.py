"""Token ids of whole texts by a tokenizers file, encoding each repeated chunk once per worker."""

from __future__ import annotations

import json
from array import array

import numpy as np

#: Chunks a worker remembers before it starts afresh; bounds its memory.
REMEMBERED = 700_000
#: Signs that may part chunks; the first that is a token by itself is used.
_SIGNS = "♥★☺"
#: Signs that part from a letter before them, whatever they are followed by among themselves.
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LOADED: dict[str, Encoder] = {}


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def loaded(path: str) -> Encoder:
    """The worker's encoder for ``path``; later tasks of the worker find it warm."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _traits(path: str) -> tuple[bool, bool]:
    """Whether the file keeps only matches of a pattern that parts letters, signs and white space; whether it lower-cases."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    first = steps[0] if steps else {}
    kept = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    bytewise = [s.get("type") for s in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
    parts = kept and bytewise and first["pattern"].get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    lowers = any(n.get("type") == "Lowercase" for n in (spec.get("normalizer") or {}).get("normalizers", []))
    return bool(parts and not spec.get("post_processor")), lowers


class Encoder:
    """``encode`` gives what the tokenizer gives for the whole text.

    Where the tokenizer drops white space, no token reaches across a blank, so
    a text is the chain of its chunks (and a word with signs after it the chain of both); unknown chunks are encoded together,
    parted by a sign that none of them holds. Other tokenizers get the whole text.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        added = self._tokenizer.get_added_tokens_decoder().values()
        alone = [(sign, self._whole(sign)) for sign in _SIGNS]
        self._mark, self._mark_id = next(((c, i) for c, i in alone if len(i) == 4), ("", b""))
        chunked, self._lowers = _traits(path)
        self._chunked = bool(self._mark) and chunked
        self._apart = [self._mark, *(t.content for t in added)]
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._letters = {code: letters(chr(code))[0][0] for code in range(128, 256)}
        self._model = self._tokenizer.model
        self._remembered, self._known = remembered, {"": b""}
        self.size = self._tokenizer.get_vocab_size()

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """A word of letters below 256 has only its case to lose before the model sees it."""
        word = word.lower() if self._lowers else word
        found = self._model.tokenize(word if word.isascii() else word.translate(self._letters))
        return array("I", [t.id for t in found]).tobytes()

    def _learn(self, chunks: set[str]) -> None:
        if len(self._known) + len(chunks) > self._remembered:
            self._known = {"": b""}
        known, plain = self._known, []
        for chunk in chunks:
            stem = chunk.rstrip(_TAIL)
            if not stem.isalpha() or max(stem) > "\xff":
                plain.append(chunk)
                continue
            ids = known.get(stem)
            if ids is None:
                ids = known[stem] = self._word(stem)
            if len(stem) < len(chunk):
                tail = known.get(chunk[len(stem) :])
                if tail is None:
                    tail = known[chunk[len(stem) :]] = self._whole(chunk[len(stem) :])
                known[chunk] = ids + tail
        alone = [c for c in plain if any(m in c for m in self._apart)]
        for chunk in alone:
            known[chunk] = self._whole(chunk)
        self._learn_plain(list(set(plain).difference(alone)))

    def _learn_plain(self, plain: list[str]) -> None:
        mark = int.from_bytes(self._mark_id, "little")
        for at in range(0, len(plain), 500):
            part = plain[at : at + 500]
            raw = self._whole(f" {self._mark} ".join(part))
            ends = np.append(np.flatnonzero(np.frombuffer(raw, dtype="<u4") == mark), len(raw) // 4).tolist()
            begin = 0
            for chunk, end in zip(part, ends, strict=True):
                self._known[chunk] = raw[4 * begin : 4 * end]
                begin = end + 1

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self._chunked:
            return self._whole(text)
        if self._lowers and text.isascii():
            lower = text.lower()  # fewer different chunks, the same ids
            if not any(m.lower() in lower for m in self._apart):
                text = lower
        chunks = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self._known.__getitem__, chunks))
        except KeyError:
            wanted = set(chunks)
            fresh = wanted.difference(self._known)
            self._learn(wanted if len(self._known) + len(fresh) > self._remembered else fresh)
            return b"".join(map(self._known.__getitem__, chunks))
