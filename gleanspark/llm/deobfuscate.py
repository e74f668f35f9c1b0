"""Noisy-channel restoration of obfuscated words: Viterbi over character lattices.

A written token is a lattice: a look-alike symbol may stand for each of its letters or for
nothing, a run of one character for one or two of it, and gaps between lone characters for
nothing or for a space. The best path under a character language model (four letters) and
the channel's costs is the restored word.
"""

from __future__ import annotations

import unicodedata

import numpy as np

#: Letters that look-alike symbols stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
              "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c",
              "<": "c", "€": "e", "£": "l", "#": "h", "*": "abcdefghijklmnopqrstuvwxyz"}
SEPARATORS = ".-_~/\\,:;'`"
#: Costs of the channel, in natural logarithms.
SWAP, COLLAPSE, DROP, BREAK = -1.0, -0.5, -5.0, -3.0

_FOLD = 0x250                                     # letters below are folded to a-z


def _class_of(code: int) -> int:
    """0: no letter; 1-26: a-z without accents; 27: any other letter."""
    c = chr(code)
    if not c.isalpha():
        return 0
    base = unicodedata.normalize("NFKD", c.lower())[0]
    return ord(base) - 96 if "a" <= base <= "z" else 27


CLASSES = np.array([_class_of(c) for c in range(_FOLD)], "uint8")


def classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    out = CLASSES[np.minimum(code, _FOLD - 1)]
    far = code >= _FOLD
    if far.any():
        out[far] = np.array([27 if chr(c).isalpha() else 0 for c in code[far]], "uint8")
    return out


def count_grams(text: str) -> np.ndarray:
    """Counts of (three classes before, class): 2 ** 20 cells of 5 bits each. What stands
    before the last gap counts as gap."""
    s = classes(f" {text} ")
    s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])].astype("int64")
    pad = np.concatenate([[0, 0], s])
    a, b, c, d = pad[:-3].copy(), pad[1:-2].copy(), pad[2:-1], pad[3:]
    a[(b == 0) | (c == 0)] = 0
    b[c == 0] = 0
    return np.bincount(a << 15 | b << 10 | c << 5 | d, minlength=1 << 20)


def log_model(counts: np.ndarray, k: float = 4.0) -> np.ndarray:
    """log P(class | three before), each order smoothed by the shorter one."""
    c = counts.reshape(32, 32, 32, 32).astype("float64")
    p = (c.sum((0, 1, 2)) + 0.5) / (c.sum() + 16)
    for axes in ((0, 1), (0,), ()):
        n = c.sum(axes) if axes else c
        p = (n + k * p) / (n.sum(-1, keepdims=True) + k)
    return np.log(p).astype("float32").ravel()


class Restorer:
    def __init__(self, log_p: np.ndarray):
        self.p = log_p

    def _steps(self, token: str):
        """Alternatives (letters, cost) of each run of the token."""
        i = 0
        while i < len(token):
            c, j = token[i], i
            while j < len(token) and token[j] == c:
                j += 1
            run, i = j - i, j
            if c == " ":
                yield [("", 0.0), (" ", BREAK)]
            elif c.isalpha():
                yield [(c, 0.0)] if run == 1 else [(c * 2, 0.0)] if run == 2 else \
                    [(c, COLLAPSE), (c * 2, COLLAPSE)]
            elif c in LOOKALIKES:
                letters = LOOKALIKES[c]
                cost = SWAP - float(np.log(len(letters)))
                yield [("", DROP)] + [(x * n, cost) for x in letters for n in range(1, min(run, 2) + 1)]
            else:
                yield [("", DROP if c.isdigit() else 0.0)]

    def decode(self, token: str) -> str:
        """The best path of the whole lattice; linear in the token's length."""
        p = self.p
        best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}       # last three classes -> path
        for step in self._steps(token):
            after: dict[int, tuple[float, tuple]] = {}
            for state, (score, path) in best.items():
                for letters, cost in step:
                    s, v = state, score + cost
                    for x in letters:
                        k = 0 if x == " " else int(classes(x)[0])
                        v += float(p[s << 5 | k])
                        s = 0 if k == 0 else (s << 5 | k) & 0x7FFF
                    if s not in after or v > after[s][0]:
                        after[s] = (v, (path, letters) if letters else path)
            best = after
        _, path = max(((v + float(p[s << 5]), q) for s, (v, q) in best.items()), key=lambda x: x[0])
        parts = []
        while path:
            path, letters = path
            parts.append(letters)
        return "".join(reversed(parts))

    def token(self, token: str) -> str:
        """A token (no white space) restored; one that cannot be obfuscated is only
        lower-cased and freed of the marks around it."""
        t = token.lower()
        end = len(t)
        while end and not t[end - 1].isalnum():
            end -= 1
        at = 0
        while at < end and not t[at].isalnum():
            at += 1
        if at and at < end and t[at - 1] in LOOKALIKES and (at < 2 or t[at - 2] != t[at - 1]):
            at -= 1                                   # one look-alike in front: "$cum"
        t = t[at:end]
        if t.isalpha():
            return self.decode(t) if _has_run(t) else t
        if not any(c.isalpha() for c in t):
            return t
        parts, cut = [], 0
        for i, c in enumerate(t + "."):
            if c in SEPARATORS:
                if i > cut:
                    parts.append(t[cut:i])
                cut = i + 1
        if len(parts) > 2 and all(len(x) == 1 for x in parts):
            return self.decode("".join(parts))        # i.d.i.o.t
        if len(parts) > 1:
            return " ".join(self.token(x) for x in parts)
        return self.decode(t)


def _has_run(t: str) -> bool:
    """Three of one letter in a row."""
    return any(t[i] == t[i + 1] == t[i + 2] for i in range(len(t) - 2))
