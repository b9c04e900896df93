"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding merges adjacent symbols: an agenda holds every adjacent pair that forms a piece,
ordered by score and then from the left; the best pair is merged, its new neighbours enter
the agenda, and pairs whose symbols are gone are skipped.  Symbols outside the vocabulary
fall back to bytes.

Texts are cut where no merge can reach: between two characters that stand together in no
piece.  Ids of words are remembered in two generations of bounded size, so the agenda
runs on new words alone.  All new words of an Arrow batch are also encoded by the
sentencepiece library in one call; where ids differ, the library's are taken, and the
documents show it in ``corrected`` (0 for the vocabularies tested).  Decoding is the
library's, by batches.

Defined cases: a null text counts as empty, and has the end id alone; rows are encoded one by
one, repeated or not; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.memo import begin, remembers

BLANK = "▁"
#: entries a generation of remembered words may have (each some 300 bytes), and the longest word remembered
GENERATION = 300_000
LONGEST = 48


class Vocabulary:
    """Pieces, scores and byte pieces of a merge-type model without normalisation rules."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = model.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        kinds = {p.type for p in spec.pieces}
        if (spec.trainer_spec.model_type != 2 or norm.precompiled_charsmap or not norm.add_dummy_prefix
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or kinds & {4, 5}):
            raise ValueError(f"{path}: only merge-type models with plain normalisation")
        n = sp.get_piece_size()
        self.end = sp.eos_id()
        #: piece -> (order in the agenda, id)
        self.pieces = {sp.id_to_piece(i): (-sp.get_score(i), i) for i in range(n)
                       if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.joined = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}

    def symbol(self, s: str) -> tuple[int, ...]:
        if s in self.pieces:
            return (self.pieces[s][1],)
        return tuple(self.bytes[b] for b in s.encode()) if self.bytes else (self.unknown,)

    def merge(self, text: str) -> tuple[int, ...]:
        """Ids of escaped text by the agenda of adjacent pairs."""
        pieces = self.pieces
        symbols: list[str] = list(text)
        after = list(range(1, len(text) + 1))
        before = list(range(-1, len(text) - 1))
        agenda = []
        for i in range(len(symbols) - 1):
            found = pieces.get(text[i:i + 2])
            if found:
                agenda.append((found[0], i, i + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            symbols[left], symbols[right] = a + b, ""
            after[left] = nxt = after[right]
            if nxt < len(symbols):
                before[nxt] = left
                pair = a + b + symbols[nxt]
                if found := pieces.get(pair):
                    heapq.heappush(agenda, (found[0], left, nxt, len(pair)))
            prev = before[left]
            if prev >= 0:
                pair = symbols[prev] + a + b
                if found := pieces.get(pair):
                    heapq.heappush(agenda, (found[0], prev, left, len(pair)))
        return tuple([i for s in symbols if s for i in self.symbol(s)])


class _Words(dict):
    """Remembered words: the younger generation, that asks the older one and then ``learn``."""

    def __init__(self, learn: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.learn, self.old = learn, {}
        self.new: dict[str, tuple[int, ...]] = {}       # learned, and not checked yet

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.old.get(word)
        if ids is None:
            ids = self.new[word] = self.learn(word)
        self[word] = ids
        return ids

    def age(self) -> None:
        for w in [w for w in self.new if len(w) > LONGEST]:
            del self[w]
        self.new = {}
        if len(self) > GENERATION:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Encodes whole texts, remembering the ids of words."""

    #: an escaped text in words: line ends, blanks with the word after them, and what is left
    WORDS = re.compile(f"\n|{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+")
    #: marks of which each starts a word of its own where no piece joins them to what is before
    MARKS = ",."
    PAIRS = ",,", ",.", ".,", ".."
    BEFORE_MARK = re.compile("(.)[,.]", re.DOTALL)

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        joined = self.vocabulary.joined
        self.plain = not any("\n" in x for x in joined)
        self.no_mark_after = {c for c in map(chr, range(0x3000))
                              if not any(c + m in joined for m in self.MARKS)} - {" ", "\n", BLANK}
        self.known = _Words(lambda key: self.encode_word(self.escaped(key)))
        self.parts: dict[str, tuple[int, ...]] = {}
        self.digits = [str(i) for i in range(self.vocabulary.library.get_piece_size())]

    def _part(self, part: str) -> tuple[int, ...]:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.vocabulary.merge(part)
            if len(self.parts) > GENERATION:
                self.parts.clear()
            if len(part) <= LONGEST:
                self.parts[part] = ids
        return ids

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of escaped text, cut where no piece can reach over."""
        joined, out, at = self.vocabulary.joined, [], 0
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in joined:
                out += self._part(word[at:i])
                at = i
        out += self._part(word[at:])
        return tuple(out)

    def words(self, text: str) -> list[str]:
        """Keys of a text's words: a word with a blank before it is written without that
        blank, text after a line end with the line end, other text after two of them."""
        if BLANK not in text and text[0] not in self.MARKS and self.plain:
            cut = text.replace("\n", " \n")
            if (not any(p in text for p in self.PAIRS)
                    and self.no_mark_after.issuperset(self.BEFORE_MARK.findall(text))):
                cut = cut.replace(",", " \n\n,").replace(".", " \n\n.")
            cut = cut.split(" ")
            if "" not in cut:
                return cut
        found = self.WORDS.findall(BLANK + text.replace(" ", BLANK))
        return [w[1:] if w[0] == BLANK and len(w) > 1 and w[1] != BLANK else
                w if w == "\n" or w[0] == BLANK else "\n\n" + w for w in found]

    def escaped(self, key: str) -> str:
        if key.startswith("\n\n"):
            return key[2:]
        return key if key[0] in ("\n", BLANK) else BLANK + key

    def encode_batch(self, texts: list[str]) -> tuple[list[list[int]], list[int]]:
        """For each text its ids with the end id, and the number of its words corrected."""
        known, tail = self.known, [self.vocabulary.end]
        cuts = [self.words(t) if t else [] for t in texts]
        out = [[i for ids in map(known.__getitem__, cut) for i in ids] + tail for cut in cuts]
        corrected = [0] * len(texts)
        wrong = self.differing(known.new)
        if wrong:
            known.update(wrong)
            out = [[i for ids in map(known.__getitem__, cut) for i in ids] + tail for cut in cuts]
            corrected = [sum(w in wrong for w in cut) for cut in cuts]
        known.age()
        return out, corrected

    def differing(self, new: dict[str, tuple[int, ...]]) -> dict[str, tuple[int, ...]]:
        """The library's ids of those words for which it has others.  It puts a blank before
        every text; where the word has none, a line end keeps that blank apart."""
        sp, wrong = self.vocabulary.library, {}
        usual = [w for w in new if w[0] not in ("\n", BLANK)]
        for w, ids in zip(usual, sp.encode(usual, num_threads=1), strict=True):
            if tuple(ids) != new[w]:
                wrong[w] = tuple(ids)
        lead = len(self.vocabulary.symbol(BLANK))
        line = lead + len(self.vocabulary.symbol("\n"))
        other = [w for w in new if w[0] in ("\n", BLANK)]
        texts = [e if (e := self.escaped(w))[0] == "\n" else "\n" + e for w in other]
        for w, text, ids in zip(other, texts, sp.encode(texts, num_threads=1), strict=True):
            ids = tuple(ids[lead if text is self.escaped(w) or text == self.escaped(w) else line:])
            if ids != new[w]:
                wrong[w] = ids
        return wrong


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


remembers("piece_codec", _encoder.cache_clear)


def encoder(path: str) -> Encoder:
    """One encoder for each worker process, as long as it serves this operator."""
    begin("piece_codec")
    return _encoder(path)


#: code points of texts that are encoded and checked together
TOGETHER = 1 << 20

DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, corrected long"


def _groups(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``TOGETHER`` code points, with their first row."""
    first, held, size = 0, [], 0
    for k, value in enumerate(column):
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= TOGETHER:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) of every document, the end id included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(model)
        for batch in batches:
            for first, texts in _groups(batch.column(1)):
                ids, _ = e.encode_batch(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ids)), pa.array(ids, pa.list_(pa.int32()))],
                                                 names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Ids of every document encoded, decoded again, and both as SHA-256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(model)
        decode, digits = e.vocabulary.library.decode, e.digits
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            for first, texts in _groups(batch.column(1)):
                rows = [(len(ids), sha(" ".join([digits[i] for i in ids])), sha(decode(ids)), c)
                        for ids, c in zip(*e.encode_batch(texts), strict=True)]
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(rows)), *map(pa.array, cols)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "corrected"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, DIGEST)
