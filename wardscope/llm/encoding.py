"""Token ids by the tokenizers library, with a memo of words."""

from __future__ import annotations

import json
import os
import unicodedata
from functools import lru_cache
from itertools import filterfalse

import numpy as np

IDS = np.dtype("<u4")


class Encoder:
    """Ids of whole texts by a tokenizers file, as the library gives them with ``add_special_tokens=False``.

    For two kinds of files the ids of a text are known to be those of its words one after another: byte-level BPE without
    normalizer, where a lone space opens the next word and a lone line break stands by itself, and the kind that drops
    white space. There each word is encoded once and kept in a memo of two generations of at most ``limit`` words; texts
    that cannot be divided so, texts with the string of an added token (which is one id), and other files are encoded
    whole. The ids are equal either way.
    """

    def __init__(self, path: str, limit: int = 400_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit, self.young, self.old = limit, {}, {}
        plan = json.loads(self.tokenizer.to_str())
        before, form = plan.get("pre_tokenizer") or {}, plan.get("normalizer")
        model, added = plan["model"], plan.get("added_tokens") or []
        self.added = [t["content"] for t in added]
        self.by_space = (form is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
                         and before.get("use_regex", True) and model.get("type") == "BPE" and not model.get("dropout"))
        parts = before.get("pretokenizers", [])
        self.by_word = (bool(form) and [n["type"] for n in form.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
                        and [p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0]["behavior"] == "Removed" and parts[0]["invert"]
                        and r"[^\s\p{L}\p{N}]+" in parts[0]["pattern"].get("Regex", "") and model.get("end_of_word_suffix") == "</w>"
                        and not model.get("dropout") and not any(t.get("normalized") for t in added))
        self.marks = {m: ids.tobytes() for m, ids in zip(",.", self._whole([",", "."]))}
        names = sorted(self.tokenizer.get_vocab(with_added_tokens=True).items(), key=lambda item: item[1])
        self.sizes = np.zeros(names[-1][1] + 1, dtype=np.int64)  # bytes of a token; byte-level tokens have a character for each
        self.closes = np.zeros(names[-1][1] + 1, dtype=bool)
        for name, number in names:
            self.sizes[number], self.closes[number] = len(name.encode()) if name in self.added else len(name), name.endswith("</w>")

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=IDS) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: list[str], marks: list[int]) -> list[bytes] | None:
        """Ids of words encoded in one go; ``marks`` has the bytes or the word ends of each. None if the sum differs."""
        ids = self._whole(["".join(words)])[0]
        ends = np.cumsum(self.sizes[ids] if self.by_space else self.closes[ids])
        wanted = np.cumsum(marks)
        stops = np.searchsorted(ends, wanted) + 1
        if not len(ends) or ends[-1] != wanted[-1] or (ends[stops - 1] != wanted).any():
            return None
        raw, bounds = ids.tobytes(), (4 * stops).tolist()
        return [raw[a:b] for a, b in zip([0, *bounds], bounds)]

    def _learn(self, words: set[str]) -> None:
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        missing = set(filterfalse(self.young.__contains__, words))
        back = set(filter(self.old.__contains__, missing))
        self.young.update((w, self.old[w]) for w in back)
        new, alone = list(missing - back), []
        ended = [w for w in new if w[-1:] in self.marks and "A" <= w[-2:-1] < "\u0250" and w[-2].isalpha() and len(w[-2].lower()) == 1]
        stems = {w[:-1] for w in ended}  # a comma or full stop after a Latin letter is a token of its own
        new = [w for w in set(new).difference(ended) | stems if w not in self.young]
        if self.by_space:
            odd = [w for w in new if w[:1].isspace() and w[:1] != "\n" or w.split() != [w.removeprefix("\n")]]
            self.young.update(dict.fromkeys(odd))  # other white space: what holds such a word is encoded whole
            new = list(set(new).difference(odd)) if odd else new
            sent = [w if w[0] == "\n" else " " + w for w in new]
            marks = [len(w.encode()) for w in sent]
        else:
            sent, marks, plain = [], [], []
            for w in new:
                stem = w[:-1] if w[-1:] in ",.;:!?" else w
                if stem.isalpha() and stem.lower().isalpha() and unicodedata.is_normalized("NFC", stem):
                    plain.append(w)
                    sent.append(w + " ")
                    marks.append(1 + (len(stem) < len(w)))
                else:
                    alone.append(w)
            new = plain
        for k in range(0, len(new), 500):
            found = self._joined(sent[k:k + 500], marks[k:k + 500])
            if found is None:
                alone += new[k:k + 500]
            else:
                self.young.update(zip(new[k:k + 500], found))
        if alone:
            texts = [w if self.by_word or w[0] == "\n" else " " + w for w in alone]
            self.young.update((w, ids.tobytes()) for w, ids in zip(alone, self._whole(texts)))
        for w in ended:
            stem = self.young[w[:-1]]
            self.young[w] = None if stem is None else stem + self.marks[w[-1]]

    def _of_words(self, words: list[str] | None) -> np.ndarray | None:
        try:
            return np.frombuffer(b"".join(map(self.young.__getitem__, words)), dtype=IDS)
        except TypeError:  # no list, or a word without ids of its own
            return None

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text (null: none)."""
        if self.by_word:
            words = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        elif self.by_space:  # a line break goes in front, so that the first word is no different from others
            words = [("\n" + t).replace("\n", " \n").split(" ")[1:] if t else [] for t in texts]
        else:
            words = [None if t else [] for t in texts]
        words = [None if w and any(map(t.__contains__, self.added)) else w for w, t in zip(words, texts)]
        self._learn(set().union(*(w for w in words if w)))
        skip = 0 if self.by_word else 1
        found = [ids[skip:] if (ids := self._of_words(w)) is not None else None for w in words]
        whole = iter(self._whole([t for t, ids in zip(texts, found) if ids is None]))
        return [next(whole) if ids is None else ids for ids in found]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per file and worker process, so that tasks share its memo."""
    return Encoder(path)
