"""Whole texts to token ids with a public tokenizer, each distinct piece encoded once.

Both JSON vocabularies cut a text at white space before they look at merges,
so ids of a text are the ids of its pieces one after another.  Texts repeat
their words; a worker therefore keeps the ids of the pieces it has seen and
only hands new ones to the library.  A tokenizer of another kind gets whole
texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Callable, Sequence
from functools import partial
from itertools import accumulate, chain, pairwise
from pathlib import Path

import numpy as np

#: White space as the vocabularies' patterns see it (fixed values).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space for ``str.split`` alone.
SEPARATORS = re.compile("[\x1c-\x1f]")
DOUBLE = re.compile(f" (?<=[{SPACE}] )")
#: White space at the edge of a piece or of several joined by a space, or a separator anywhere.
ODD = re.compile(f"^[{SPACE}]|[{SPACE}]$|[{SPACE}] | [{SPACE}]|[\x1c-\x1f]")
#: Latin letters but U+0130: NFC and lower-casing leave each one letter; others may end in a combining mark, which joins the punctuation.
LATIN = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f"
MARK = re.compile(f"(?<=[{LATIN}])([.,])(?= )")
#: Marks between such a letter and white space or the end; no apostrophe, which may take letters to it.
ENDS = re.compile(f"[!-&(-/:-@\\[-`{{-~](?<=[{LATIN}].)[!-&(-/:-@\\[-`{{-~]*(?=[ \n]|\\Z)")
#: A text without these is the same to the library in lower case: NFC changes none of the rest, and ``lower`` each by itself.
OTHER = re.compile(f"[^\x00-\x7f{LATIN}\x80-\xbf\xd7\xf7\u2010-\u2027]")
LETTERS = re.compile(f"[{LATIN}]+")
#: Begins a piece that follows the one before without a space.
JOINED = "\x1c"
#: Where a word may be cut: before a mark that ends it, and before a line's end.
BORDER = re.compile(f"[.,\n](?:(?<=[{LATIN}][.,])(?=[ \n])|(?<=[^{SPACE}]\n))")
RUNS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Pieces that a worker keeps; beyond it, it starts anew.
MEMO = 450_000
#: New pieces that one call of the library takes together.
TOGETHER = 256

Split = Callable[[str], tuple[list[str], list[str]]]


def by_spaces(text: str) -> tuple[list[str], list[str]]:
    """Pieces that stand as they are, then words that follow a single space, or nothing where they begin with ``JOINED``.

    A cut lies between a visible character and white space, where no token of
    the pattern reaches across, or between a letter and a single mark before
    white space, which are two tokens; so words repeat more often.
    """
    if JOINED in text or DOUBLE.search(text):
        return RUNS.findall(text), []
    first, *rest = BORDER.sub(f" {JOINED}\\g<0>", text).split(" ")
    return ([first] if first else []), rest


def splitter(spec: dict) -> Split | None:
    """How texts of this vocabulary may be cut; None: not at all."""
    before, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not norm:
        return by_spaces
    steps = [x.get("type") for x in norm.get("normalizers", [])]
    parts = before.get("pretokenizers", [{}])
    drops = parts[0].get("type") == "Split" and parts[0].get("behavior") == "Removed" and parts[0].get("invert")
    if steps == ["NFC", "Replace", "Lowercase"] and drops and "[^\\s" in str((parts[0].get("pattern") or {}).get("Regex")):
        return partial(by_punctuation, special=[t["content"] for t in spec.get("added_tokens", [])])
    return None


def byte_letters(spec: dict) -> dict[int, str] | None:
    """For ``str.translate``: Latin letters in lower case to the characters that stand for their bytes; None: the model takes others."""
    parts, model = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}]), spec["model"]
    last = parts[-1]
    plain = len(parts) == 2 and last.get("type") == "ByteLevel" and not last.get("use_regex") and not last.get("add_prefix_space")
    special = any(LETTERS.fullmatch(t["content"]) for t in spec.get("added_tokens", []))
    if not plain or special or model.get("type") != "BPE" or model.get("dropout"):
        return None
    from tokenizers.pre_tokenizers import ByteLevel

    level = ByteLevel(add_prefix_space=False, use_regex=False)
    letters = {c.lower() for c in map(chr, range(0x250)) if LETTERS.fullmatch(c)}
    return {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}


def by_punctuation(text: str, special: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Words, since white space is dropped; in lower case and with the marks that end them apart, so that they repeat more often.

    Only marks between a letter that stays one and white space are set apart,
    which are a token of the pattern anyway.  A text that may have a special
    string, in any case of letters, keeps its case and has only single commas
    and full stops set apart.
    """
    if SEPARATORS.search(text):
        return [text], []
    shown = text if OTHER.search(text) else text.lower()
    if any(x in shown or x.lower() in shown for x in special):
        return MARK.sub(r" \1", text).split(), []
    return ENDS.sub(r" \g<0>", shown).split(), []


class Memo:
    """Ids of pieces; when full, it keeps those that came up again since it was half full."""

    def __init__(self, limit: int = MEMO):
        self.limit, self.ids, self.again = limit, {}, set()

    def missing(self, pieces: set[str]) -> list[str]:
        new = pieces.difference(self.ids)
        if 2 * len(self.ids) > self.limit:
            self.again |= pieces - new
        if self.ids and len(self.ids) + len(new) > self.limit:
            self.ids = {p: self.ids[p] for p in self.again if p in self.ids} if len(self.again) < self.limit // 2 else {}
            self.again = set()
            new = pieces.difference(self.ids)
        return list(new)


class Encoder:
    """``encode(texts)`` gives the ids of each text as little-endian bytes of ``dtype``."""

    def __init__(self, content: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        spec = json.loads(content)
        added = spec.get("added_tokens", [])
        plain = not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word", "normalized"))
        self.tokenizer = Tokenizer.from_str(content.decode("utf-8"))
        self.split = splitter(spec) if plain else None
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t["content"] for t in added]
        self.lowers = bool(spec.get("normalizer"))
        self.end = spec["model"].get("end_of_word_suffix") or ""
        vocabulary = self.tokenizer.get_vocab()
        self.widths = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():  # a byte-level token has a character for each byte
            self.widths[i] = len(token.removesuffix(self.end) if self.end else token)
        self.alone, self.spaced = Memo(), Memo()
        self.bytes_of = byte_letters(spec) if self.split and self.lowers else None

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=self.dtype).tobytes() for x in found]

    def _together(self, pieces: list[str], prefix: str) -> list[bytes]:
        """Many words in one call; the bytes that each id stands for tell where a word's ids end."""
        texts = [prefix + (prefix or " ").join(pieces[i : i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
        out: list[bytes] = []
        for i, found in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            words = pieces[i * TOGETHER : (i + 1) * TOGETHER]
            shown = [unicodedata.normalize("NFC", w).lower() for w in words] if self.lowers else words
            ids = np.array(found.ids, dtype=np.int64)
            ends = np.cumsum([len(prefix) + len(w.encode()) for w in shown])
            covered = np.cumsum(self.widths[ids])
            cuts = np.searchsorted(covered, ends) + 1
            if len(ids) and covered[-1] == ends[-1] and (covered[cuts - 1] == ends).all():
                raw, size = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
                bounds = [0, *(cuts * size).tolist()]
                out += [raw[a:b] for a, b in pairwise(bounds)]
            else:
                out += self._library([prefix + w for w in words])
        return out

    def _words(self, words: list[str], prefix: str) -> list[bytes]:
        """Ids of each word after the prefix."""
        if self.bytes_of and not prefix:
            letters = {w for w in words if w.isalpha() and LETTERS.fullmatch(w)}
            if letters:
                known = self._letters(list(letters))
                known.update(zip(rest := [w for w in words if w not in letters], self._spaced(rest, prefix), strict=True))
                return [known[w] for w in words]
        return self._spaced(words, prefix)

    def _letters(self, words: list[str]) -> dict[str, bytes]:
        """Words of Latin letters alone are one token of the pattern, so the library's model takes them as they are."""
        model, size = self.tokenizer.model, self.dtype.itemsize
        found = [[t.id for t in model.tokenize(w.lower().translate(self.bytes_of))] for w in words]
        raw = np.fromiter(chain.from_iterable(found), self.dtype).tobytes()
        bounds = [0, *(size * x for x in accumulate(map(len, found)))]
        return {w: raw[a:b] for w, (a, b) in zip(words, pairwise(bounds), strict=True)}

    def _spaced(self, words: list[str], prefix: str) -> list[bytes]:
        """The same by whole texts, many words in one; empty words and those with white space or special strings alone."""
        whole = " ".join(words)
        if not ODD.search(whole) and not any(x in whole for x in self.special):
            return self._together(words, prefix)
        odd = {w for w in words if not w or ODD.search(w) or any(x in w for x in self.special)}
        apart = iter(self._library([prefix + w for w in words if w in odd]))
        plain = iter(self._together([w for w in words if w not in odd], prefix))
        return [next(apart if w in odd else plain) for w in words]

    def _learn(self, known: Memo, pieces: set[str], prefix: str) -> None:
        new = known.missing(pieces)
        if not (prefix or self.lowers):
            known.ids.update(zip(new, self._library(new), strict=True))
            return
        joined = [p for p in new if p.startswith(JOINED)] if prefix else []
        lines = [p for p in joined if p.startswith("\n", 1)]
        marks = [p for p in joined if not p.startswith("\n", 1)]
        words = [p for p in new if not p.startswith(JOINED)] if joined else new
        known.ids.update(zip(lines, self._words([p[2:] for p in lines], "\n"), strict=True))
        known.ids.update(zip(marks, self._library([p[1:] for p in marks]), strict=True))
        known.ids.update(zip(words, self._words(words, prefix), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.split is None:
            return self._library(texts)
        cut = [self.split(t) for t in texts]
        self._learn(self.alone, set().union(*(a for a, _ in cut)), "")
        self._learn(self.spaced, set().union(*(b for _, b in cut)), " ")
        alone, spaced = self.alone.ids.__getitem__, self.spaced.ids.__getitem__
        return [b"".join(map(alone, a)) + b"".join(map(spaced, b)) for a, b in cut]


class Pieces:
    """The same for a sentencepiece model."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.dtype = np.dtype("<u2" if self.model.vocab_size() <= 1 << 16 else "<u4")

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(x, dtype=self.dtype).tobytes() for x in self.model.encode(texts, num_threads=1)]


_LOADED: dict[str, Encoder | Pieces] = {}


def load(path: str) -> bytes:
    """A vocabulary file's bytes; they travel to the workers with the function that uses them."""
    return Path(path).read_bytes()


def version(path: str, content: bytes) -> str:
    """Digest of a vocabulary and of the library that applies it."""
    import sentencepiece
    import tokenizers

    library = f"sentencepiece {sentencepiece.__version__}" if path.endswith(".model") else f"tokenizers {tokenizers.__version__}"
    return hashlib.sha256(content + library.encode()).hexdigest()


def encoder(content: bytes, model: bool = False) -> Encoder | Pieces:
    """One encoder per worker process and vocabulary."""
    key = hashlib.md5(content).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Pieces(content) if model else Encoder(content)
    return _LOADED[key]
