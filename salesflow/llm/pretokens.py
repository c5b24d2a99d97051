"""Word boundaries of byte-level BPE without regular expressions: codepoint classes and a scan of transition functions.

The pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` looks at most two characters ahead. That is
folded into the symbol of a character (an apostrophe that opens a contraction, a blank before something else), so the rest is a machine of
eight states that reads one symbol at a time. A symbol is a function from states to states; functions compose associatively, so all rows
of a block are composed side by side, the rows by doubling, and the states are then filled in.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import tiktoken

BLOCK_BYTES = 1 << 18
COLUMNS = 256
APOSTROPHE, SPACE = 39, 32
_LETTER, _NUMBER, _OTHER, _BLANK_SPACE, _BLANK = range(5)
# Symbols. SHORT and LONG are apostrophes of contractions with one and two letters; the LAST ones stand before a character that is no blank.
LETTER, NUMBER, OTHER, SHORT, LONG, LAST_SPACE, LAST_BLANK, BLANK = range(8)
IDENTITY = 16
# States. FREE: the next character opens a word; JOIN: a space that the next character joins; REST1, REST2: letters left of a contraction.
FREE, IN_LETTERS, IN_NUMBER, IN_OTHER, JOIN, IN_BLANKS, REST1, REST2 = range(8)
STATES = 8


@cache
def classes() -> np.ndarray:
    """The class of every codepoint, as the library whose results must be met has them."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    single = {bytes([b]): b for b in range(256)}

    def having(pattern: str) -> np.ndarray:
        found = bytes(tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary("".join(points)))
        return np.frombuffer(found.decode().encode("utf-32-le"), np.uint32)

    table = np.full(0x110000, _OTHER, np.uint8)
    table[having(r"\p{L}")] = _LETTER
    table[having(r"\p{N}")] = _NUMBER
    table[having(r"\s")] = _BLANK
    table[SPACE] = _BLANK_SPACE
    return table


@cache
def machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a word opens, at symbol * STATES + state; symbols from 8 on are first in their text, the last changes nothing."""
    opened = {LETTER: IN_LETTERS, NUMBER: IN_NUMBER, OTHER: IN_OTHER, SHORT: REST1, LONG: REST2, LAST_SPACE: JOIN, LAST_BLANK: FREE, BLANK: IN_BLANKS}
    goes_on = {
        IN_LETTERS: {LETTER: IN_LETTERS}, IN_NUMBER: {NUMBER: IN_NUMBER}, IN_BLANKS: {BLANK: IN_BLANKS},
        IN_OTHER: dict.fromkeys((OTHER, SHORT, LONG), IN_OTHER),
        JOIN: {LETTER: IN_LETTERS, NUMBER: IN_NUMBER} | dict.fromkeys((OTHER, SHORT, LONG), IN_OTHER),
        REST1: dict.fromkeys(opened, FREE), REST2: dict.fromkeys(opened, REST1),
    }
    after, opens = np.tile(np.arange(STATES), (IDENTITY + 1, 1)), np.zeros((IDENTITY + 1, STATES), bool)
    for symbol, fresh in opened.items():
        after[symbol + 8], opens[symbol + 8] = fresh, True
        for state in range(STATES):
            kept = goes_on.get(state, {}).get(symbol)
            after[symbol, state], opens[symbol, state] = (fresh, True) if kept is None else (kept, False)
    return after.ravel().astype(np.int16), opens.ravel()


def _symbols(point: np.ndarray, ahead: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Symbols of codepoints; ``ahead`` holds up to two codepoints after them, ``first`` and ``last`` the places where texts begin and end."""
    table = classes()
    kind = table[point]
    blank = kind >= _BLANK_SPACE
    follows = np.empty(len(point), bool)  # something else than a blank comes next
    follows[:-1] = ~blank[1:]
    follows[-1] = len(ahead) > 0 and table[ahead[0]] < _BLANK_SPACE
    follows[last] = False
    symbol = np.where(blank, np.where(follows, np.where(kind == _BLANK_SPACE, LAST_SPACE, LAST_BLANK), BLANK), kind).astype(np.int16)
    mark = np.flatnonzero(point == APOSTROPHE)
    if len(mark):
        further = np.concatenate((point, ahead, np.zeros(2, np.uint32)))
        one, two = further[mark + 1], further[mark + 2]
        room = np.concatenate((last, [len(point) + len(ahead)]))[np.searchsorted(last, mark)] - mark  # characters of the text after it
        pair = (one.astype(np.uint64) << np.uint64(32)) | two
        pairs = [(ord(a) << 32) | ord(b) for a, b in ("re", "ve", "ll")]
        symbol[mark[(room > 1) & np.isin(pair, np.array(pairs, np.uint64))]] = LONG
        symbol[mark[(room > 0) & np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
    symbol[first] += 8
    return symbol


def _opened(symbol: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Places where words open, and the state after the last symbol, from ``state`` on."""
    after, opens = machine()
    rows = -(-len(symbol) // COLUMNS)
    padded = np.full(rows * COLUMNS, IDENTITY * STATES, np.int16)
    padded[:len(symbol)] = symbol * STATES
    by_column = np.ascontiguousarray(padded.reshape(rows, COLUMNS).T)
    whole = np.tile(np.arange(STATES, dtype=np.int16), (rows, 1))  # each row's function so far
    for column in by_column:
        whole = after[column[:, None] + whole]
    shift = 1
    while shift < rows:  # prefixes of rows, doubled
        later = np.take_along_axis(whole[shift:], whole[:-shift], 1)
        whole = np.concatenate((whole[:shift], later))
        shift *= 2
    now = np.concatenate(([state], whole[:-1, state])).astype(np.int16)
    before = np.empty((COLUMNS, rows), np.int16)
    for k, column in enumerate(by_column):
        before[k] = column + now
        now = after[before[k]]
    found = opens[before].T.reshape(-1)[:len(symbol)]
    return np.flatnonzero(found), int(whole[-1, state])


def boundaries(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Byte offsets at which words begin in ``data``, valid UTF-8 texts one after another; ``starts``: where the non-empty texts begin.

    Blocks of ``BLOCK_BYTES`` carry their state on, so a text of any length needs little memory and no word is cut.
    """
    out, state, at = [], FREE, 0
    starts = np.asarray(starts, np.int64)
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        raw = np.frombuffer(data, np.uint8, end - at, at)
        place = np.flatnonzero((raw & 0xC0) != 0x80)
        point = np.frombuffer(data[at:end].decode().encode("utf-32-le"), np.uint32)
        ahead = np.frombuffer(data[end:end + 8].decode("utf-8", "ignore")[:2].encode("utf-32-le"), np.uint32)
        begun = starts[np.searchsorted(starts, at):np.searchsorted(starts, end)]
        ends = starts[np.searchsorted(starts, at, side="right"):np.searchsorted(starts, end, side="right")]
        last = np.searchsorted(place, ends - at) - 1
        if end == len(data):
            last = np.append(last, len(place) - 1)
        # Two characters ahead may belong to the next text; what begins there ends what lies before.
        cut = starts[np.searchsorted(starts, end):np.searchsorted(starts, end + 8)] - end
        if len(cut):
            ahead = ahead[:len(data[end:end + int(cut[0])].decode())]
        words, state = _opened(_symbols(point, ahead, np.searchsorted(place, begun - at), last), state)
        out.append(place[words] + at)
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.int64)
