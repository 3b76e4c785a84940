"""Pre-token boundaries of byte-level BPE without a regular expression.

The split rule (``public_tokenizers.PATTERN``) is run as a small automaton
over codepoint classes.  Every character becomes a *transition function*
(state -> state); functions compose associatively, so the state before every
character comes from a blocked prefix scan over an array of function codes,
not from a character loop:

1. codepoint-class array: letter, number, other, U+0020, other white space --
   refined by one or two characters of lookahead (``'re``, a space before a
   non-space), which are plain array shifts;
2. the transition functions reachable by composition form a finite monoid;
   its elements are numbered and their composition is a lookup table;
3. scan: all blocks advance one column per step (one table gather per step),
   block totals are scanned recursively, then states follow from one gather;
4. a boundary lies before a character iff ``BOUNDARY[state, class]`` says so;
   for white space it depends on its neighbours only.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE, WHITE = range(5)

# Code points that Unicode 16.0 added to the categories L* and
# N*.  The rank files' split rule follows Unicode 16; an older unicodedata of
# the Python running the tasks lacks them.
ADDED_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
ADDED_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
# Code points with the White_Space property, U+0020 apart.
WHITE_SPACE = (
    (0x09, 0x0D), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
    (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """uint8 class of every code point."""
    t = np.zeros(0x110000, np.uint8)
    major = {"L": LETTER, "N": NUMBER}
    t[:] = np.fromiter((major.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
                       np.uint8, 0x110000)
    for ranges, cls in ((ADDED_LETTERS, LETTER), (ADDED_NUMBERS, NUMBER), (WHITE_SPACE, WHITE)):
        for a, b in ranges:
            t[a:b + 1] = cls
    t[0x20] = SPACE
    return t


# --- the automaton -----------------------------------------------------------
# States: what the match that is open before a character is doing.
FRESH, IN_L, IN_N, IN_O, PREFIX, C1, C2 = range(7)
# Symbols: classes refined by lookahead.  S: U+0020 before a non-space; A2 and
# A3: an apostrophe that could start a two or three character contraction.
W, S, L, N, O, A2, A3 = range(7)
_RUN = {L: IN_L, N: IN_N, O: IN_O}


def _step(state: int, sym: int) -> tuple[int, bool]:
    """(next state, boundary before the character)."""
    if sym == W:
        return FRESH, True
    if sym == S:
        return PREFIX, True
    if state == C2:
        return C1, False
    if state == C1:
        return FRESH, False
    if sym in (A2, A3):
        if state in (PREFIX, IN_O):        # swallowed by a run of other characters
            return IN_O, False
        return (C1 if sym == A2 else C2), True
    if state == PREFIX or state == _RUN[sym]:
        return _RUN[sym], False
    return _RUN[sym], True


@lru_cache(maxsize=1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code of symbol [14], compose [256*256], apply [256*8], boundary [8*8]).

    Symbols 7..13 are symbols 0..6 at the start of a text: the constant
    functions that ignore the state before.  Code 0 is the identity.
    """
    plain = [tuple(_step(s, y)[0] for s in range(7)) for y in range(7)]
    gens = plain + [(f[FRESH],) * 7 for f in plain]
    ident = tuple(range(7))
    elems, todo = {ident: 0}, [ident]
    while todo:                                    # closure under composition
        f = todo.pop()
        for g in gens:
            h = tuple(g[f[s]] for s in range(7))   # first f, then g
            if h not in elems:
                elems[h] = len(elems)
                todo.append(h)
    assert len(elems) <= 256
    order = sorted(elems, key=elems.get)
    compose = np.zeros((256, 256), np.uint8)
    apply = np.zeros((256, 8), np.uint8)
    for f in order:
        apply[elems[f], :7] = f
        for g in order:
            compose[elems[f], elems[g]] = elems[tuple(g[f[s]] for s in range(7))]
    boundary = np.zeros((8, 8), bool)
    for s in range(7):
        for y in range(7):
            boundary[s, y] = _step(s, y)[1]
    return np.array([elems[g] for g in gens], np.uint8), compose.ravel(), apply.ravel(), boundary.ravel()


def exclusive_scan(codes: np.ndarray, block: int = 256) -> np.ndarray:
    """Composition of all functions before each position (code 0 before the first)."""
    _, compose, _, _ = monoid()
    n = len(codes)
    if n == 0:
        return codes.copy()
    rows = -(-n // block)
    cols = np.zeros(rows * block, np.uint8)
    cols[:n] = codes
    cols = np.ascontiguousarray(cols.reshape(rows, block).T)
    out = np.empty_like(cols)
    acc = np.zeros(rows, np.uint16)
    for t in range(block):                         # every block advances one character
        out[t] = acc
        acc = compose[(acc << 8) | cols[t]].astype(np.uint16)
    if rows > 1:
        before = exclusive_scan(acc.astype(np.uint8), block).astype(np.uint16)
        out = compose[(before << 8)[None, :] | out]
    return out.T.reshape(-1)[:n]


def boundaries(cps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """True where a pre-token begins.

    ``cps``: the code points of one or more texts in a row; ``starts``: True
    at the first code point of each text.
    """
    n = len(cps)
    if n == 0:
        return np.zeros(0, bool)
    code_of, _, apply, table = monoid()
    cls = class_table()[cps]
    white = cls >= SPACE
    inner = ~starts                                # has a character before it in its text
    next_solid = np.zeros(n, bool)
    next_solid[:-1] = ~white[1:] & inner[1:]
    prev_white = np.zeros(n, bool)
    prev_white[1:] = white[:-1] & inner[1:]
    sym = np.array([O, L, N, W, W], np.uint8)[cls]
    sym[(cls == SPACE) & next_solid] = S
    at = np.flatnonzero(cps == 0x27)
    if len(at):
        pad = np.zeros(n + 2, np.uint32)
        pad[:n] = cps
        ends = np.ones(n + 2, bool)
        ends[:n] = starts
        one, two = pad[at + 1], pad[at + 2]
        ok1 = ~ends[at + 1]
        ok2 = ok1 & ~ends[at + 2]
        short = ok1 & np.isin(one, [ord(c) for c in "stmd"])
        long = ok2 & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
                      | ((one == ord("l")) & (two == ord("l"))))
        sym[at[short]] = A2
        sym[at[long]] = A3
    scan = exclusive_scan(code_of[sym + np.uint8(7) * starts])
    state = apply[scan.astype(np.uint16) * 8 + FRESH]
    cut = table[state.astype(np.uint16) * 8 + sym]
    cut = np.where(white, ~prev_white | next_solid, cut)
    return cut | starts
