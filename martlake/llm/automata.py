"""Dense automata stepped over many text stretches at once.

Texts are cut into stretches; all stretches of a block advance together, one
symbol per numpy operation, so the cost per symbol is a table lookup and not a
Python step. Memory is bounded by the block, whatever a text's length.
"""

from __future__ import annotations

import numpy as np


def stretches(off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, begin, end) of consecutive stretches of at most ``length``
    symbols of every non-empty document (``off``: symbol offsets)."""
    sizes = np.diff(off)
    number = -(-sizes // length)
    doc = np.repeat(np.arange(len(sizes)), number)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    begin = off[doc] + nth * length
    return doc, begin, np.minimum(begin + length, off[doc + 1])


def columns(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, pad: int, before: int = 0):
    """Stretches as an array (steps, stretches), padded behind with ``pad``. With
    ``before`` each stretch also gets that many symbols in front of it."""
    steps = int((end - begin).max()) + before
    at = (begin - before)[None, :] + np.arange(steps, dtype=np.int64)[:, None]
    out = symbols[np.minimum(at, len(symbols) - 1)]
    out[at >= end[None, :]] = pad
    return out


def suffix_automaton(symbols: list[int], alphabet: int) -> np.ndarray:
    """Transitions (states, alphabet) of the suffix automaton of ``symbols``; -1:
    none. State 0 is the start; every path spells a substring."""
    nxt, link, size, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if size[q] == size[p] + 1:
                link[cur] = q
            else:  # split: the shorter substrings of q become a state of their own
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                link[q] = link[cur] = twin
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
        last = cur
    table = np.full((len(nxt), alphabet), -1, np.int64)
    for s, moves in enumerate(nxt):
        for c, t in moves.items():
            table[s, c] = t
    return table
