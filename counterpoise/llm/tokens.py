"""Token ids of many texts with the tokenizers library, one encoding per distinct chunk.

A tokenizer whose pre-tokenizer never joins text across a blank gives the same ids
when a text is cut at blanks first.  Chunks repeat far more often than texts, so each
distinct chunk of a worker is encoded once and texts become array look-ups.
``cut_word`` fits tokenizers that drop white space, ``cut_blank`` byte-level ones whose
words carry their leading blank.  A text with white space other than blank and line
feed is not cut for the latter but encoded whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from counterpoise.llm.common import give_back, ship

ship(__name__)

# A worker outlives jobs and even versions of this file: what it keeps is named by the file's content.
_VERSION = zlib.crc32(__loader__.get_data(__file__))
MAX_CHUNKS = 800_000  # distinct chunks kept by a worker; beyond it those seen once are forgotten
# Whole runs of these marks between a letter and white space are pre-tokens of their own.
_MARKS = r"[.,;:!?%&$#*|]+"
_BLANK = re.compile(rf" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?={_MARKS}(?:[ \n]|\Z))|(?<=[A-Za-zÀ-ÖØ-öø-ÿ]){_MARKS}(?=[ \n]|\Z)| ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+")
_TRAILING = re.compile(rf"(?<=[a-zß-öø-ÿ])({_MARKS})(?=[ \n]|\Z)")
_OTHER_SPACE = re.compile("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]")


def cut_word(text: str) -> list[str]:
    """For tokenizers that lower-case and drop white space."""
    try:
        text.encode("latin-1")  # in this range lower-casing first changes nothing
        text = _TRAILING.sub(r" \1", text.lower())
    except UnicodeEncodeError:
        pass
    return text.replace("\n", " ").split(" ")


# Chunks of byte-level tokenizers are named without their leading blank; BARE marks a chunk that has none.
BARE = "\x01"
_JOINED_MARK = re.compile(r"[^A-Za-z0-9À-ÖØ-öø-ÿ][.,] ")


def cut_blank(text: str) -> list[str]:
    """For tokenizers whose words carry their leading blank; see ``blank_chunk``."""
    if not text:
        return []
    if _OTHER_SPACE.search(text):
        return [BARE + text]
    if BARE in text or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n":
        return [c[1:] if len(c) > 1 and c[0] == " " and c[1] not in " \n" and BARE not in c else c if c == "\n" else BARE + c for c in _BLANK.findall(text)]
    if not _JOINED_MARK.search(text):
        text = text.replace(", ", f" {BARE}, ").replace(". ", f" {BARE}. ")
    return (BARE + text.replace("\n", f" \n {BARE}")).split(" ")


# Texts that ``blank_names`` leaves to ``cut_blank``: other white space, blanks or line feeds side by side or at an end, none at all.
_UNEVEN = ("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200f}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}\\x01]"
           "|[ \\n][ \\n]|^[ \\n]|[ \\n]\\z|^\\z")
_CLOSING = "([A-Za-z0-9À-ÖØ-öø-ÿ])([.,;:!?])([ \\n]|\\z)"


def blank_names(column: pa.Array) -> pa.ListArray:
    """The chunks of even texts, as ``cut_blank`` names them; a mark that closes a word is a chunk of its own."""
    marked = pc.replace_substring_regex(column, _CLOSING, f"\\1 {BARE}\\2\\3")
    return pc.split_pattern(pc.binary_join_element_wise(BARE, pc.replace_substring(marked, "\n", f" \n {BARE}"), ""), " ")


def blank_chunk(name: str) -> str:
    """The text of a chunk of ``cut_blank``."""
    return name[1:] if name[0] == BARE else name if name == "\n" else " " + name


class _Table(dict):
    """chunk -> number, in order of first use; new chunks wait in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.fresh.append(chunk)
        return n


class Encoder:
    def __init__(self, path: str, cut, room: int | None = None):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The text of a special token inside a document is ordinary text: it must not become a control id.
        self.tokenizer.encode_special_tokens = True
        self.cut = cut
        self.room = room
        # Asked by name: jobs pickle functions by value, so the same function is another object in the next job.
        self.drops_space = cut.__name__ == cut_word.__name__
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.leads = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.leads[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True  # a byte-level blank
        self.feed = vocabulary.get("\u010a", -1)  # a byte-level line feed
        self._reset()

    def _reset(self):
        self.table = _Table()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1, np.int64)
        self.seen = np.zeros(0, np.int64)

    def _forget(self):
        """Keep the chunks seen most often, at most half the room."""
        old, ids, at, seen = self.table, self.ids, self.at, self.seen
        keep = np.flatnonzero(seen > 1)
        keep = np.sort(keep[np.argsort(-seen[keep], kind="stable")][: (self.room or MAX_CHUNKS) // 2])
        stays = np.zeros(len(seen), bool)
        stays[keep] = True
        lens = np.diff(at)[keep]
        self._reset()
        self.table.update(zip((c for c, k in old.items() if stays[k]), range(len(keep))))  # in order of number
        self.at = np.concatenate([[0], np.cumsum(lens)])
        self.ids = ids[np.repeat(at[keep] - self.at[:-1], lens) + np.arange(self.at[-1])]
        self.seen = np.ones(len(keep), np.int64)

    def _learn(self):
        new = self.table.fresh
        if not new:
            return
        self.table.fresh = []
        flat, lens = self._joined(new) if self.drops_space else self._led_flat(new)
        ends = self.at[-1] + np.cumsum(lens)
        if ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.at[-1]], np.zeros(int(ends[-1]) * 2, np.uint32)])
        self.ids[self.at[-1] : ends[-1]] = flat
        self.at = np.concatenate([self.at, ends])

    def _led(self, chunks: list[str]) -> list[np.ndarray]:
        flat, n = self._led_flat(chunks)
        return np.split(flat, np.cumsum(n)[:-1])

    def _led_flat(self, chunks: list[str], per: int = 500) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of chunks of a byte-level tokenizer: many to a text, told apart by the ids that begin with a blank; those without one, by the line feeds between them."""
        which: list = []  # chunks as they were encoded, with their ids and lengths
        parts: list[np.ndarray] = []
        lens: list = []
        left: list[int] = []
        one = lambda text: np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        plain, bare = [], []
        for i, c in enumerate(chunks):
            if c[0] != BARE and c != "\n":
                plain.append(i)
            elif 1 < len(c) < 100 and c[0] == BARE and " " not in c and "\n" not in c and not _OTHER_SPACE.search(c):
                bare.append(i)
            else:
                left.append(i)
        for lo in range(0, len(plain), per):
            some = plain[lo : lo + per]
            ids = one(" " + " ".join([chunks[i] for i in some]))
            begins = np.flatnonzero(self.leads[ids])
            if len(begins) == len(some) and not begins[0]:
                which.append(some)
                parts.append(ids)
                lens.append(np.diff(begins, append=len(ids)))
            else:
                left += some
        for lo in range(0, len(bare), per):
            some = bare[lo : lo + per]
            ids = one("\n".join([blank_chunk(chunks[i]) for i in some]))
            feeds = np.flatnonzero(ids == self.feed)
            if len(feeds) == len(some) - 1:
                which.append(some)
                parts.append(np.delete(ids, feeds))
                lens.append(np.diff(feeds, prepend=-1, append=len(ids)) - 1)
            else:
                left += some
        if left:
            got = [e.ids for e in self.tokenizer.encode_batch_fast([blank_chunk(chunks[i]) for i in left], add_special_tokens=False)]
            which.append(left)
            parts += [np.asarray(x, np.uint32) for x in got]
            lens.append(np.array([len(x) for x in got], np.int64))
        # Back to the chunks' order.
        order, n, flat = np.concatenate(which), np.concatenate(lens), np.concatenate(parts)
        begin, back = np.cumsum(n) - n, np.argsort(order, kind="stable")
        n, begin = n[back], begin[back]
        return flat[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(len(flat))], n

    def _joined(self, chunks: list[str], per: int = 500) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of chunks of a tokenizer that drops white space, encoded many to a text and told apart by offsets."""
        out: list[np.ndarray] = []
        groups = [chunks[i : i + per] for i in range(0, len(chunks), per)]
        for group, e in zip(groups, self.tokenizer.encode_batch(["\n".join(g) for g in groups], add_special_tokens=False)):
            begins = np.cumsum([0] + [len(c) + 1 for c in group])
            firsts = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids))
            out += np.split(np.asarray(e.ids, np.uint32), np.searchsorted(firsts, begins[1:-1]))
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def _numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all chunks one after another, and how many each text has."""
        numbers, count = [], np.zeros(len(texts), np.int64)
        look = self.table.__getitem__
        for i, t in enumerate(texts):
            chunks = self.cut(t)
            count[i] = len(chunks)
            numbers.append(np.fromiter(map(look, chunks), np.int64, len(chunks)))
        return np.concatenate(numbers) if numbers else np.zeros(0, np.int64), count

    def _column_numbers(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without null, to be cut by ``cut_blank``: even ones are cut and their distinct chunks found by Arrow."""
        even = ~pc.match_substring_regex(column, _UNEVEN).to_numpy(zero_copy_only=False)
        names = blank_names(column.filter(pa.array(even)))
        coded = names.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.table.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        if even.all():
            return number, np.diff(names.offsets.to_numpy())
        count = np.zeros(len(column), np.int64)
        count[even] = np.diff(names.offsets.to_numpy())
        others, count[~even] = self._numbers(column.filter(pa.array(~even)).to_pylist())
        flat, of_even = np.empty(count.sum(), np.int64), np.repeat(even, count)
        flat[of_even], flat[~of_even] = number, others
        return flat, count

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's ids begin (one more entry than texts)."""
        if len(self.table) > (self.room or MAX_CHUNKS):
            self._forget()
        flat, count = self._numbers(texts) if isinstance(texts, list) else self._column_numbers(texts)
        self._learn()
        seen = np.bincount(flat, minlength=len(self.at) - 1)
        seen[: len(self.seen)] += self.seen
        self.seen = seen
        lens = (self.at[1:] - self.at[:-1])[flat]
        ends = np.concatenate([[0], np.cumsum(lens)])
        where = np.repeat(self.at[flat] - ends[:-1], lens) + np.arange(ends[-1])
        return self.ids[where], ends[np.concatenate([[0], np.cumsum(count)])]


def encoder(path: str, cut, room: int | None = None) -> Encoder:
    """The worker's encoder of a tokenizer file: it outlives the task, as does the library's module.  ``room`` in place of MAX_CHUNKS."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_counterpoise_encoders", {})
    key = (path, cut.__name__, room, _VERSION)
    if key not in held:
        held[key] = Encoder(path, cut, room)
    return held[key]


def drop_encoders() -> None:
    """At the start of a task that encodes nothing: what the encoders of an earlier job hold in this worker goes."""
    import sys

    library = sys.modules.get("tokenizers")
    if library is not None and library.__dict__.pop("_counterpoise_encoders", None):
        give_back()


def column_slices(column: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Where to cut a string column into slices of about ``most`` bytes: (from, to); a longer text is a slice of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo, n = 0, len(column)
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield lo, hi
        lo = hi


def text_slices(column: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, int, list[str]]]:
    """The slices of ``column_slices`` with their texts, null as empty."""
    for lo, hi in column_slices(column, most):
        yield lo, hi, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
