"""Byte-pair encoding by a deterministic automaton over tokens.

The merges are compiled one after another, each by a merge gadget. Before any merge there is one state a byte, and every
state has an arc for every byte. The gadget of merge (a, b) -> c lets c lead to a copy of the state that b leads to, cuts the
arc b out of the state that a leads to, and gives every state that still has the arc a an arc c. So the state is the last token read, and the label paths through the finished automaton are exactly the token sequences that the merges produce.
A text's bytes spell one such path only; it is found by longest tokens first, going back where no arc leads on.

The table of arcs would have as many rows as columns as there are tokens, so an arc is read off the gadgets' record
when it is first needed (each step undoes the later of the two gadgets concerned) and kept from then on; likewise
the finished path of each pre-split word. Both tables start anew when full: they are copies of what can be worked out again.
"""

from __future__ import annotations

import base64
import json
import re
import unicodedata
from itertools import chain

import regex

#: Fixed value: how a text is cut into words before encoding (the pattern published with the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MAX_WORDS = 400_000
MAX_ARCS = 2_000_000

_ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def _first_plane(pattern: str):
    """The same pattern for texts of the first Unicode plane, its classes written out by rule: a table lookup a character."""

    def spans(test) -> str:
        out: list[list[int]] = []
        for c in (c for c in range(0x10000) if test(chr(c))):
            if out and out[-1][1] == c - 1:
                out[-1][1] = c
            else:
                out.append([c, c])
        return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in out)

    letters, numbers = (spans(lambda ch, k=k: unicodedata.category(ch)[0] == k) for k in "LN")
    blanks = spans(lambda ch: ch.isspace() and not "\x1c" <= ch <= "\x1f")
    for old, new in ((r"[^\s\p{L}\p{N}]", f"[^{blanks}{letters}{numbers}]"), (r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"), (r"\S", f"[^{blanks}]"), (r"\s", f"[{blanks}]")):
        pattern = pattern.replace(old, new)
    return re.compile(pattern)


class _Done(dict):
    """Finished paths by word; a word met for the first time is worked out."""

    def __init__(self, path) -> None:
        super().__init__()
        self.path = path

    def __missing__(self, word: str) -> tuple[int, ...]:
        got = self.path(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 64:
            if len(self) > MAX_WORDS:
                self.clear()
            self[word] = got
        return got


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins for bytes in the vocabulary file: bytes that print as themselves keep their code, the others follow from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def read_merges(data: bytes) -> tuple[list[bytes], list[tuple[int, int, int]]]:
    """(token bytes by id, merges (left, right, new) by rank) of a vocabulary file: the JSON kind, or lines of base64 and rank."""
    if data.lstrip()[:1] == b"{":
        model, back = json.loads(data)["model"], _byte_letters()
        raw = lambda s: bytes(back[c] for c in s)
        vocab = model["vocab"]
        words = [b""] * (max(vocab.values()) + 1)
        for s, i in vocab.items():
            words[i] = raw(s) if all(c in back for c in s) else b""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return words, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    ranks = {base64.b64decode(a): int(r) for a, r in (line.split() for line in data.splitlines() if line)}
    words = [b""] * (max(ranks.values()) + 1)
    for w, r in ranks.items():
        words[r] = w
    merges = []
    for w in sorted((w for w in ranks if len(w) > 1), key=ranks.__getitem__):
        parts = [bytes([c]) for c in w]
        while len(parts) > 2:  # a token's own merges, all of lower rank, leave its last two parts
            k = min(range(len(parts) - 1), key=lambda k: ranks.get(parts[k] + parts[k + 1], 1 << 60))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        merges.append((ranks[parts[0]], ranks[parts[1]], ranks[w]))
    return words, merges


class MergeAutomaton:
    def __init__(self, data: bytes) -> None:
        self.words, merges = read_merges(data)
        n = len(self.words)
        self.left, self.right, self.born = [-1] * n, [-1] * n, [0] * n
        self.cut: dict[tuple[int, int], int] = {}  # arc (state, label) -> the gadget that cut it out
        self.arcs: dict[tuple[int, int], bool] = {}
        for at, (a, b, c) in enumerate(merges, 1):
            self.gadget(at, a, b, c)
        self.ids = {w: i for i, w in enumerate(self.words) if w and (self.born[i] or len(w) == 1)}
        self.longest = max(map(len, self.ids), default=0)
        # for every token, the tokens that are its prefixes, longest first: where to go on from when the longest has no arc
        self.shorter = {i: next((self.ids[w[:k]] for k in range(len(w) - 1, 0, -1) if w[:k] in self.ids), -1) for w, i in self.ids.items()}
        self.prefixes = {w[:k] for w in self.ids for k in range(1, len(w))}
        self.split_any = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.split_first = _first_plane(PATTERN).findall
        self.done = _Done(self.path)

    def gadget(self, at: int, a: int, b: int, c: int) -> None:
        """Merge number `at`: cut b out of a's state, let c lead to a copy of b's state."""
        if not self.born[c]:
            self.left[c], self.right[c], self.born[c] = a, b, at
        self.cut.setdefault((a, b), at)

    def arc(self, state: int, label: int) -> bool:
        """Whether the finished automaton has the arc `label` out of the state that token `state` leads to."""
        key = (state, label)
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) > MAX_ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._arc(state, label)
        return known

    def _arc(self, state: int, label: int) -> bool:
        """Follow the copies back: at time `now` the later born of state and label stands for the one it was copied from.

        Times count by halves: a gadget copies the state first (2 * at), cuts, then gives the arcs (2 * at + 1); so where a = b, c's state keeps the arc that a's loses.
        """
        now, born, left, right, cut = 1 << 60, self.born, self.left, self.right, self.cut
        while True:
            gone = cut.get((state, label))
            if gone is not None and 2 * gone < now:
                return False
            if not born[state] and not born[label]:
                return True
            if born[state] > born[label]:
                now, state = min(now, 2 * born[state]), right[state]  # its state is a copy of its right part's, made then
            else:
                now, label = min(now, 2 * born[label] + 1), left[label]  # the arc was given to states that had the left part's arc then

    def _longest_at(self, word: bytes, at: int) -> int:
        """The longest token that `word` has at `at`."""
        ids, prefixes, found = self.ids, self.prefixes, -1
        for end in range(at + 1, min(len(word), at + self.longest) + 1):
            s = word[at:end]
            found = ids.get(s, found)
            if s not in prefixes:
                break
        return found

    def path(self, word: bytes) -> tuple[int, ...]:
        """The one path of the automaton that spells `word`; each offset is given up at most once, so the time is linear in its length."""
        whole = self.ids.get(word)
        if whole is not None:
            return (whole,)
        words, out, ends, dead = self.words, [], [0], bytearray(len(word) + 1)
        token = self._longest_at(word, 0)
        while True:
            at = ends[-1]
            end = at + len(words[token])
            if not dead[end] and (not out or self.arc(out[-1], token)):
                out.append(token)
                ends.append(end)
                if end == len(word):
                    return tuple(out)
                token = self._longest_at(word, end)
                continue
            token = self.shorter[token]
            while token < 0:
                dead[at] = 1
                ends.pop()
                at = ends[-1]
                token = self.shorter[out.pop()]

    def pre_split(self, text: str) -> list[str]:
        return self.split_any(text) if _ASTRAL.search(text) else self.split_first(text)

    def encode(self, text: str) -> list[int]:
        """Token ids of a text, without special tokens; their strings in a text are ordinary text."""
        return list(chain.from_iterable(map(self.done.__getitem__, self.pre_split(text))))

    def count(self, text: str) -> int:
        return sum(map(len, map(self.done.__getitem__, self.pre_split(text))))

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs taken, one after another."""
        return b"".join(self.words[i] for i in ids).decode("utf-8", "replace")
