"""The text rules that the plan of a document needs in turn, on plain strings; `text` has them as columns."""
from __future__ import annotations

import math
import re
import unicodedata
from functools import lru_cache

from . import constants as K
from .text import FOLD_FROM, FOLD_TO

_FOLD = str.maketrans(FOLD_FROM, FOLD_TO)
_STEM = re.compile("^(.{4,}?)(?:" + "|".join(K.SUFFIXES) + ")$")
_STOP, _LINKS, _VERBS = frozenset(K.STOP_WORDS), frozenset(K.CONNECTIVES), frozenset(K.VERB_FORMS)
_ENDINGS = tuple(K.VERB_ENDINGS)


def fold_accents(text: str) -> str:
    folded = text.lower().translate(_FOLD)
    return folded if folded.isascii() else "".join(c for c in folded if unicodedata.category(c) != "Mn")


def tokens(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", fold_accents(text))


@lru_cache(maxsize=1 << 15)
def stem(word: str) -> str:
    return re.sub("^(.{4,})d$", r"\1", _STEM.sub(r"\1", word))


def content_set(words: list[str]) -> set[str]:
    return {stem(w) for w in words if len(w) > 2 and w not in _STOP}


def word_count(text: str) -> int:
    """Of a text whose words are separated by single blanks."""
    return text.count(" ") + 1 if text else 0


def has_verb(text: str) -> bool:
    return any(w in _VERBS or (len(w) >= K.VERB_MIN_LENGTH and w.endswith(_ENDINGS)) for w in re.findall(r"\w+", text.lower()))


def close_sentence(text: str) -> str:
    text = text.rstrip(" ,;:")
    return text if not text or text[-1] in ".!?…" else text + "."


def prune_prefix(unit: str, n: int) -> str | None:
    words = [w for w in unit.split(" ") if w]
    if n >= len(words):
        return None
    at = n
    while at < len(words) and fold_accents(words[at]).strip(",;:") in _LINKS:
        at += 1
    while at < len(words) and not words[at].strip(",;:"):
        at += 1
    rest = " ".join(words[at:]).lstrip(",;: ")
    if len(words) - at < 5 or not has_verb(rest):
        return None
    return close_sentence(rest[:1].upper() + rest[1:])


def frames_for_words(n_words: int, top: int) -> int:
    seconds = n_words / K.WORDS_PER_SECOND + K.TAIL_SECONDS
    rung = math.ceil((seconds * K.FPS - K.FRAMES_MIN) / K.LADDER_STEP - 0.5)
    return K.FRAMES_MIN + K.LADDER_STEP * max(0, min(math.floor((top - K.FRAMES_MIN) / K.LADDER_STEP), rung))


class Spoken:
    """What has been said so far, as a run of tokens that is looked up by its stretches of the least length."""

    def __init__(self, least: int = K.LITERAL_REPEAT_TOKENS):
        self.least, self.heard, self.starts = least, [], {}

    def add(self, words: list[str]) -> None:
        for word in words or [None]:            # a unit without tokens ends the run
            self.heard.append(word)
            if len(self.heard) >= self.least:
                self.starts.setdefault(tuple(self.heard[-self.least:]), []).append(len(self.heard) - self.least)

    def repeated(self, words: list[str]) -> int:
        """Length of the longest opening run of `words` said before, or 0."""
        best = 0
        for start in self.starts.get(tuple(words[:self.least]), ()) if len(words) >= self.least else ():
            n = self.least
            while n < len(words) and start + n < len(self.heard) and self.heard[start + n] == words[n]:
                n += 1
            best = max(best, n)
            if best == len(words):
                break
        return best


def repeats(stems: set[str], said: set[str]) -> tuple[int, float, bool]:
    """Fresh stems of a sentence, its repeated share, and whether it is skipped.

    The share is measured against the smaller of the two sets, so a long sentence that repeats
    a whole headline does not hide behind its own words.
    """
    n = len(stems)
    fresh = sum(stem not in said for stem in stems)
    base = min(n, len(said)) if said else n
    share = (n - fresh) / base if base else 0.0
    return fresh, share, n > 0 and (fresh < K.NEW_STEMS_MIN or share >= K.REPEAT_SHARE_MAX)


def say(sentences: list[str], cap: int, floor: int, cut: int, target: float, top: int, max_units: int, one_take: bool) -> dict:
    """Sentences packed into takes; `folds.planned` says how."""
    said: set[str] = set()
    spoken, takes, warnings, opened = Spoken(), [], [], []
    n_open, seconds = 0, 0.0

    def full():
        return len(takes) >= max_units or seconds >= target

    def close():
        nonlocal n_open, seconds, opened
        if opened:
            frames = frames_for_words(n_open, top)
            takes.append({"text": " ".join(opened), "n_words": n_open, "frames": frames})
            seconds += frames / K.FPS
            opened, n_open = [], 0

    for text in sentences:
        if full():
            break
        words = tokens(text)
        stems = content_set(words)
        if repeats(stems, said)[2]:
            warnings.append({"kind": "already_said", "detail": text})
            continue
        n = spoken.repeated(words)
        if n:
            left = prune_prefix(text, n)
            warnings.append({"kind": "repeats_literally", "detail": text} if left is None else {"kind": "pruned", "detail": left})
            if left is None:
                continue
            text, words = left, tokens(left)
            stems = content_set(words)
        size = word_count(text)
        if not one_take and opened and n_open + size > cap:
            close()
            if full():
                break
        opened.append(text)
        n_open += size
        said |= stems
        spoken.add(words)
        if not one_take and n_open >= floor and n_open + cut > cap:
            close()
    if not full():
        close()
    return {"takes": takes, "seconds": seconds, "warnings": warnings}
