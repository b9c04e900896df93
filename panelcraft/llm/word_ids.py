"""Token ids of whole texts by a ``tokenizers`` file whose tokens never span white space.

Most of a corpus is repeated words, so ids are kept per chunk between blanks, in two
generations of bounded bytes (the older is dropped when the younger is full), until the worker gets a
task of another operator; only new chunks go through the tokenizers library.  ``check_chunked`` states what a file must satisfy for
chunk-wise ids to equal those of the whole text.

Defined cases: a null text counts as empty and has no ids; a chunk of any length is encoded whole (what
is remembered is not); ids depend on the text alone, not on what was encoded before.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np

from panelcraft.llm.memo import Sized, begin, remembers

#: bytes a generation of remembered chunks (or parts of chunks) may have, and the longest one remembered
GENERATION = 28 << 20
LONGEST = 64


def check_chunked(path: str) -> None:
    """Raise unless ids of a text are those of its chunks between blanks, one after another:
    white space is dropped by a pattern that never matches it together with another character,
    and no normaliser looks past a blank."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    norm = spec.get("normalizer") or {}
    parts = norm.get("normalizers", [norm] if norm else [])
    known = all(n["type"] in ("NFC", "Lowercase") or (
        n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " ") for n in parts)
    first = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    pattern = first.get("pattern", {}).get("Regex", "")
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    if not (known and drops and pattern.endswith("[^\\s\\p{L}\\p{N}]+") and " " not in pattern
            and all(not t["lstrip"] and not t["rstrip"] for t in spec.get("added_tokens", []))):
        raise ValueError(f"{path}: its tokens may depend on what stands beyond a blank")


#: chunks that need no normaliser but lower case: printable ASCII and Latin-1 letters
PLAIN = re.compile("[!-~ªµºÀ-ÖØ-öø-ÿ]+")
#: the file's own pattern over lower-cased plain chunks
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9]|[^a-zªµºß-öø-ÿ0-9]+")
#: what a comma or a full stop may follow if it is to start a chunk of its own
_AFTER = {"", *(chr(c) for c in range(256) if chr(c).isalpha() or chr(c) in "0123456789 \n")}


class ChunkEncoder:
    """Ids of texts, as the bytes of little-endian unsigned 16-bit integers.

    Texts of Latin-1 characters are lower-cased at once.  New plain chunks are cut here,
    and each part goes through the library's merge model alone; all others go
    through the whole library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        check_chunked(path)
        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids must fit into 16 bits")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_letters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100) if chr(c).isalpha()}
        self.two = [i.to_bytes(2, "little") for i in range(self.library.get_vocab_size(with_added_tokens=True))]
        self.chunks = Sized(self._learn, GENERATION, LONGEST)
        self.parts = Sized(self._merged, GENERATION // 4, LONGEST)

    def _merged(self, part: str) -> bytes:
        two = self.two
        tokens = self.library.model.tokenize(part if part.isascii() else part.translate(self.byte_letters))
        return b"".join([two[t.id] for t in tokens])

    def _learn(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha() and chunk.islower():
            return self._merged(chunk)
        if PLAIN.fullmatch(chunk) and not ("<" in chunk and any(t in chunk for t in self.special)):
            low = chunk.lower()
            return self._merged(low) if low.isalpha() else b"".join(map(self.parts.__getitem__, PARTS.findall(low)))
        return np.array(self.library.encode(chunk, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def _cut(self, text: str) -> list[str]:
        """Chunks of a text: between blanks, and in plain texts from each single mark."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.replace("\n", " ").split(" ")
        if not any(t in text for t in self.special):
            text = text.lower()
            ends = {x[-1:] for x in text.replace(",", ".").split(".")[:-1]}
            if _AFTER.issuperset(ends) and not any(p in text for p in (",,", ",.", ".,", "..")):
                text = text.replace(",", " ,").replace(".", " .")
        return text.replace("\n", " ").split(" ")

    def encode(self, text: str | None) -> bytes:
        """Ids of one whole text (null: none)."""
        if not text:
            return b""
        ids = b"".join(map(self.chunks.__getitem__, self._cut(text)))
        self.chunks.age()
        self.parts.age()
        return ids


@cache
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


remembers("word_ids", _encoder.cache_clear)


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker process, as long as it serves this operator."""
    begin("word_ids")
    return _encoder(path)
