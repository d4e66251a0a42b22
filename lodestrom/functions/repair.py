"""Minimum-cost error parses of delimited lines and JSON lines. Pure Python over one line.

A line is read by dynamic programming over (position, parser state): each step either consumes the next symbol at no cost,
or inserts or deletes a quote or delimiter at cost 1; a typed value that cannot be read costs 1 as well. Cost 0 means that
the line is valid as it stands and its values are readable; otherwise the edits of the cheapest parse state what is wrong.
The search is banded: only parses up to a bound are followed, and the bound doubles until one reaches the end, so a line
with few errors is cheap however long it is, and none is given up.

Only quotes, delimiters and line breaks matter to the structure of a CSV line, so a run of other characters is one symbol,
and edits are made between symbols.
The edit distance to JSON has no table of bounded width (brackets nest), so its parses are searched best-first. Where the
errors are too many for that (``SEARCH_STATES``), a search by bracket levels finds the fewest edits in polynomial time; this is
what the operators use (``exact``). Without it, the edits of one pass from left to right are given there, which repair the
line but may not be the fewest. ``Parse.least`` says which it is; whether the line is valid never depends on it.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

#: States of an RFC 4180 reader: at the start of a field, in a bare field, in a quoted field, after a quote in one.
START, BARE, QUOTED, CLOSED = range(4)
_ENDS = (START, BARE, CLOSED)
_SYMBOLS = re.compile(r'[",\r\n]|[^",\r\n]+')
#: How many states the search for JSON edits may visit: so many, and so many more for each symbol.
SEARCH_STATES = (20_000, 1)


@dataclass(frozen=True)
class Parse:
    """``valid`` is the structure's verdict, ``cost`` counts edits and unreadable values; ``value`` are the fields or the object."""

    valid: bool
    cost: int
    edits: tuple[str, ...] = ()
    value: Any = None
    least: bool = True


# --- readable numbers, character by character: blanks, sign, digits, point, decimals, blanks
EMPTY, ODD, SIGN, POINT, TRAIL, DEAD = "empty", "odd", "sign", "point", "trail", "dead"


def number_state(state: str, text: str) -> str:
    """The state of the number reader after some more characters. ``d<k>`` and ``f<k>`` are k digits and k decimals."""
    for c in text:
        blank, digit = c in " \t", "0" <= c <= "9"
        if state == EMPTY:
            state = EMPTY if blank else "d1" if digit else SIGN if c in "+-" else ODD if c.isspace() else DEAD
        elif state == ODD:
            state = ODD if c.isspace() else DEAD
        elif state == SIGN:
            state = "d1" if digit else DEAD
        elif state[0] == "d" and state != DEAD:
            k = int(state[1:])
            state = f"d{k + 1}" if digit and k < 16 else POINT if c == "." else TRAIL if blank else DEAD
        elif state == POINT:
            state = "f1" if digit else DEAD
        elif state[0] == "f":
            state = "f2" if digit and state == "f1" else TRAIL if blank else DEAD
        elif state == TRAIL:
            state = TRAIL if blank else DEAD
        else:
            return DEAD
    return state


def number_fault(state: str, required: bool) -> str | None:
    """What is wrong with a value that ended in a state, or None."""
    if state in (EMPTY, ODD):
        return "has no value" if required else None
    return None if state == TRAIL or (state[0] in "df" and state != DEAD) else "is no number"


# --- CSV
def _step(state: int, symbol: str) -> int | None:
    """The next state, or None if the symbol isn't allowed there."""
    if state == QUOTED:
        return CLOSED if symbol == '"' else QUOTED
    if symbol == ",":
        return START
    if symbol == '"':
        return {START: QUOTED, CLOSED: QUOTED}.get(state)
    if symbol not in "\r\n" and state in (START, BARE):
        return BARE
    return None


def csv_fields(line: str) -> list[str] | None:
    """The fields of a line; None if it is not valid under RFC 4180. This is the parse that costs nothing."""
    fields, state = [""], START
    for s in _SYMBOLS.findall(line):
        if s == "," and state != QUOTED:
            fields.append("")
        elif s != '"' or state == CLOSED:
            fields[-1] += s
        state = _step(state, s)
        if state is None:
            return None
    return fields if state in _ENDS else None


def csv_parse(line: str, columns: int, typed: Mapping[int, bool] = {}) -> Parse:
    """The cheapest parse of a line to ``columns`` fields. ``typed`` names the columns (from 0) that hold numbers, and
    whether a number is required there. ``valid`` is about quoting alone."""
    fields = csv_fields(line)
    if fields is not None and len(fields) == columns:
        wrong = [(k, number_fault(number_state(EMPTY, fields[k]), need)) for k, need in typed.items()]
        if not any(w for _, w in wrong):
            return Parse(True, 0, (), fields)
    symbols = _SYMBOLS.findall(line)
    bound = 1
    while (best := _banded(symbols, columns, typed, bound)) is None:
        bound *= 2
    return Parse(fields is not None, *best, fields)


def _banded(symbols: list[str], columns: int, typed: Mapping[int, bool], bound: int) -> tuple[int, tuple[str, ...]] | None:
    """Cost and edits of the cheapest parse that costs at most ``bound``, or None."""
    last = columns  # one field too many is as good as several: it must lose delimiters
    # a cell is (state, field, number state of a typed field); its value is (cost, edits as a linked list)
    row: dict[tuple, tuple[int, Any]] = {(START, 0, EMPTY if 0 in typed else None): (0, None)}

    def relax(into: dict, cell: tuple, cost: int, edits: Any) -> tuple | None:
        if cost <= bound and (cell not in into or cost < into[cell][0]):
            into[cell] = (cost, edits)
            return cell
        return None

    def ended(n: int, number: str | None, cost: int, edits: Any) -> tuple[int, Any]:
        fault = number_fault(number, typed[n]) if n in typed else None
        return (cost + 1, (edits, f"column {n + 1} {fault}")) if fault else (cost, edits)

    def take(into: dict, cell: tuple, symbol: str, cost: int, edits: Any) -> tuple | None:
        state, n, number = cell
        nxt = _step(state, symbol)
        if nxt is None:
            return None
        if symbol == "," and state != QUOTED:
            cost, edits = ended(n, number, cost, edits)
            n = min(n + 1, last)
            return relax(into, (nxt, n, EMPTY if n in typed else None), cost, edits)
        if number is not None and (symbol != '"' or state == CLOSED):
            number = number_state(number, symbol)
        return relax(into, (nxt, n, number), cost, edits)

    for i, s in enumerate([*symbols, None]):
        queue = list(row)
        while queue:  # insertions before symbol i
            cell = queue.pop()
            cost, edits = row[cell]
            for mark in ('"', ","):
                if made := take(row, cell, mark, cost + 1, (edits, f"insert {mark} before symbol {i}")):
                    queue.append(made)
        if s is None:
            break
        after: dict[tuple, tuple[int, Any]] = {}
        for cell, (cost, edits) in row.items():
            take(after, cell, s, cost, edits)
            if s in '",\r\n':
                relax(after, cell, cost + 1, (edits, f"delete {s!r} at symbol {i}"))
        row = after
    ends = [ended(n, number, *v) for (state, n, number), v in row.items() if state in _ENDS and n == columns - 1]
    ends = [e for e in ends if e[0] <= bound]
    if not ends:
        return None
    cost, edits = min(ends, key=lambda v: v[0])
    said: list[str] = []
    while edits is not None:
        edits, text = edits
        said.append(text)
    return cost, tuple(reversed(said))


# --- JSON
class Number(str):
    """A JSON number as written."""


_STRING = r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"'
_SCALAR = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null")
#: Tokens: white space, valid strings, delimiters, strings with bad contents, other runs, and single quotes left over.
_TOKEN = re.compile(rf'[ \t\n\r]+|{_STRING}|[{{}}\[\]:,]|"(?:[^"\\]|\\.)*"|[^{{}}\[\]:,"\s]+|["\\\s]', re.S)
_GOOD_STRING = re.compile(_STRING)
#: Before a value, before the first key or element or the end, before a further key, after a key, after a value.
VALUE, OPEN, KEY, COLON, NEXT = "vokcn"


def json_tokens(line: str) -> list[str]:
    return [t for t in _TOKEN.findall(line) if t.strip(" \t\n\r")]


def _fits(state: str, top: str | None, token: str) -> str | None:
    """The state after a token within an object (``o``), an array (``a``) or nothing; None if it does not fit. Brackets are
    left to the caller, who keeps the stack: they give ``(`` and ``)``."""
    at_key = state == KEY or state == OPEN and top == "o"
    at_value = state == VALUE or state == OPEN and top == "a"
    if token in "{[":
        return "(" if at_value and (top is not None or token == "{") else None
    if token in "}]":
        return ")" if top == ("o" if token == "}" else "a") and state in (NEXT, OPEN) else None
    if token == ":":
        return VALUE if state == COLON else None
    if token == ",":
        return (KEY if top == "o" else VALUE) if state == NEXT and top else None
    if top is None or not (at_key or at_value):
        return None
    if _GOOD_STRING.fullmatch(token):
        return COLON if at_key else NEXT
    return NEXT if at_value and _SCALAR.fullmatch(token) else None


def _scalar(token: str) -> Any:
    if token[0] == '"':
        return json.loads(token)
    return {"true": True, "false": False, "null": None}.get(token, Number(token)) if token in ("true", "false", "null") else Number(token)


def json_object(line: str) -> dict | None:
    """The object of a line that is exactly one valid RFC 8259 object, else None: the parse that costs nothing. It keeps its
    own stack, so that any depth is read. Numbers keep their text; of a repeated key the last value counts."""
    stack: list[Any] = []
    keys: list[str] = []
    state, whole = VALUE, None

    def put(value: Any) -> None:
        if isinstance(stack[-1], dict):
            stack[-1][keys.pop()] = value
        else:
            stack[-1].append(value)

    for token in json_tokens(line):
        top = None if not stack else "o" if isinstance(stack[-1], dict) else "a"
        nxt = _fits(state, top, token)
        if nxt is None or (whole is not None and not stack):
            return None
        if nxt == "(":
            made: Any = {} if token == "{" else []
            if stack:
                put(made)
            else:
                whole = made
            stack.append(made)
            state = OPEN
        elif nxt == ")":
            stack.pop()
            state = NEXT
        else:
            if nxt == COLON:
                keys.append(_scalar(token))
            elif nxt == NEXT:
                put(_scalar(token))
            state = nxt
    return whole if whole is not None and not stack else None


def json_amount(value: Any) -> str | None:
    """The text of an amount: of a string or number as written, of anything else something unreadable; None if there is none."""
    return None if value is None else str(value) if isinstance(value, str) else f"a {type(value).__name__}"


def json_parse(line: str, amount: str = "amount", exact: bool = False) -> Parse:
    """The cheapest parse of a line to one object whose ``amount`` is a readable number. With ``exact`` the edits are the
    fewest whatever the damage, else those of one pass where ``SEARCH_STATES`` do not suffice."""
    value = json_object(line)
    if value is not None:
        fault = number_fault(number_state(EMPTY, json_amount(value.get(amount)) or ""), True)
        return Parse(True, int(bool(fault)), (f"{amount} {fault}",) if fault else (), value)
    symbols = _JSON_SYMBOLS.findall(line)
    found = _json_edits(symbols, amount)
    if found is None and exact:
        found = _json_edits_by_level(symbols, amount)
    cost, edits = found or _repair(json_tokens(line))
    return Parse(False, cost, edits, None, found is not None)


#: What the error parse takes as one symbol: quotes and delimiters, escapes, white space, and runs of anything else.
_JSON_SYMBOLS = re.compile(r'["{}\[\]:,]|\\.|\\|\s+|[^"{}\[\]:,\\\s]+', re.S)
_CONTROL = re.compile(r"[\x00-\x1f]")
_ESCAPE = re.compile(r'\\["\\/bfnrtu]')
#: Where the reader is: outside of strings; in a key (nothing read yet, just the amount's name, anything else); in a value.
_OUT, _KEY_EMPTY, _KEY_NAMED, _KEY_OTHER, _TEXT = "o", "k", "n", "x", "t"


def _json_edits(symbols: list[str], amount: str) -> tuple[int, tuple[str, ...]] | None:
    """The fewest edits to one object with a readable amount; None where that takes too long to find.

    A state is (stack, parser state, where, number state of the amount's text, whether the amount's value is due and was
    seen). The heap takes the cheapest first and among these the one that has read furthest.
    """
    # stacks are numbered: (parent, kind) of each; 0 is the empty one
    parents: list[tuple[int, str | None]] = [(0, None)]
    known: dict[tuple[int, str], int] = {}

    def deeper(stack: int, kind: str) -> int:
        if (stack, kind) not in known:
            known[stack, kind] = len(parents)
            parents.append((stack, kind))
        return known[stack, kind]

    def advance(symbol: str, cell: tuple) -> tuple[tuple, str | None] | None:
        """The cell after a symbol and what is wrong with it (at cost 1), or None if it does not fit."""
        stack, state, where, number, due, seen = cell
        if where != _OUT:
            if symbol == '"':
                if where == _TEXT:
                    return (stack, NEXT, _OUT, None, False, seen or due), due and number_fault(number, True) and f"{amount} {number_fault(number, True)}"
                return (stack, COLON, _OUT, None, where == _KEY_NAMED and parents[stack][0] == 0, seen), None
            wrong = "mend the string" if _CONTROL.search(symbol) or symbol[0] == "\\" and not _ESCAPE.fullmatch(symbol) else None
            if where == _TEXT:
                return (stack, state, where, number_state(number, symbol) if due else None, due, seen), wrong
            return (stack, state, _KEY_NAMED if where == _KEY_EMPTY and symbol == amount else _KEY_OTHER, None, due, seen), wrong
        if symbol.isspace():
            return cell, None if symbol.strip(" \t\n\r") == "" else "delete white space"
        if stack == 0 and state == NEXT:
            return None  # after the object
        top = parents[stack][1]
        if symbol == '"':
            if top is None or state in (COLON, NEXT):
                return None
            key = state == KEY or state == OPEN and top == "o"
            return (stack, state, _KEY_EMPTY if key else _TEXT, EMPTY if due else None, due, seen), None
        nxt = _fits(state, top, symbol)
        if nxt is None:
            return None
        if nxt == "(":
            return (deeper(stack, "o" if symbol == "{" else "a"), OPEN, _OUT, None, False, seen or due), f"{amount} is no number" if due else None
        if nxt == ")":
            return (parents[stack][0], NEXT, _OUT, None, False, seen), None
        if nxt == NEXT and due:
            fault = number_fault(number_state(EMPTY, json_amount(_scalar(symbol)) or ""), True)
            return (stack, NEXT, _OUT, None, False, True), fault and f"{amount} {fault}"
        return (stack, nxt, _OUT, None, due, seen), None

    start = (0, VALUE, _OUT, None, False, False)
    heap: list = [(0, 0, 0, start, None)]
    done: set = set()
    serial = 0
    effort = SEARCH_STATES[0] + SEARCH_STATES[1] * len(symbols)

    def push(cost: int, i: int, moved: tuple[tuple, str | None], edits: Any, edit: str | None) -> None:
        nonlocal serial
        cell, wrong = moved
        for said in (edit, wrong):
            if said:
                cost, edits = cost + 1, (edits, said)
        serial += 1
        heapq.heappush(heap, (cost, -i, serial, cell, edits))

    while heap:
        cost, negative, _, cell, edits = heapq.heappop(heap)
        i = -negative
        if (i, cell) in done:
            continue
        done.add((i, cell))
        stack, state, where, number, due, seen = cell
        if i == len(symbols) and stack == 0 and state == NEXT:
            if seen:
                return cost, _told(edits)
            push(cost, i, ((0, NEXT, _OUT, None, False, True), f"{amount} has no value"), edits, None)
            continue
        if len(done) > effort:
            return None
        if i < len(symbols):
            s = symbols[i]
            if moved := advance(s, cell):
                push(cost, i + 1, moved, edits, None)
            if s == '"' or where == _OUT and s in "{}[]:,":
                push(cost, i + 1, (cell, None), edits, f"delete {s} at symbol {i}")
            elif where == _OUT and not s.isspace():
                push(cost + 1, i + 1, (cell, None), edits, f"delete {s[:20]} at symbol {i}")
        for mark in '"{}[]:,' if where == _OUT else '"':
            if moved := advance(mark, cell):
                push(cost, i, moved, edits, f"insert {mark} before symbol {i}")
    return None


def _wrong_in_string(symbol: str) -> bool:
    return bool(_CONTROL.search(symbol)) or symbol[0] == "\\" and not _ESCAPE.fullmatch(symbol)


def _flat_steps(cell: tuple, symbol: str) -> tuple[list[tuple], int]:
    """Where a symbol may lead a reader that forgets what is around its bracket, and what it costs at least."""
    kind, state, where = cell
    if where != _OUT:
        if symbol == '"':
            return [(kind, NEXT if where == _TEXT else COLON, _OUT)], 0
        return [cell], int(_wrong_in_string(symbol))
    if symbol.isspace():
        return [cell], int(symbol.strip(" \t\n\r") != "")
    if kind is None and state == NEXT or symbol == '"' and (kind is None or state in (COLON, NEXT)):
        return [], 0
    if symbol == '"':
        return [(kind, state, _KEY_OTHER if state == KEY or state == OPEN and kind == "o" else _TEXT)], 0
    nxt = _fits(state, kind, symbol)
    if nxt is None:
        return [], 0
    if nxt == "(":
        return [("o" if symbol == "{" else "a", OPEN, _OUT)], 0
    return ([(k, NEXT, _OUT) for k in (None, "o", "a")] if nxt == ")" else [(kind, nxt, _OUT)]), 0


def _least_to_go(symbols: list[str], toll: int = 0) -> list[dict[tuple, int]]:
    """For each position and cell of the reader of :func:`_flat_steps`, the fewest edits to the end: no reader with a stack
    can do with fewer, so a search may go by it. Each bracket that opens costs a ``toll``
    more and each that closes as much less (from -1 to 1): with the toll of the brackets that are open, this is a lower bound
    too, since all of them are closed in the end."""
    cells, near = [(None, VALUE, _OUT)], {}
    tolls = lambda c, s: 0 if c[2] != _OUT else toll if s in "{[" else -toll if s in "}]" else 0
    for c in cells:  # all cells there are, and those that one inserted symbol leads to
        near[c] = [(n, 1 + tolls(c, mark)) for mark in '"{}[]:,' if c[2] == _OUT or mark == '"' for n in _flat_steps(c, mark)[0]]
        cells += [n for n in dict.fromkeys((*(n for n, _ in near[c]), *_flat_steps(c, "1")[0])) if n not in cells]
    never = 1 << 60
    steps: dict[str, dict[tuple, tuple[list[tuple], int, int]]] = {}
    after = {c: 0 if c == (None, NEXT, _OUT) else never for c in cells}
    found: list[dict[tuple, int]] = []
    for s in (None, *reversed(symbols)):
        if s is not None:
            if s not in steps:
                mark, space = s in '"{}[]:,', s.isspace()
                flat = {c: _flat_steps(c, s) for c in cells}
                steps[s] = {c: (flat[c][0], flat[c][1] + tolls(c, s), 1 if s == '"' or c[2] == _OUT and mark else 2 if c[2] == _OUT and not space else never) for c in cells}
            after = {c: min([after[c] + drop, *(after[n] + more for n in to)]) for c, (to, more, drop) in steps[s].items()}
        changed = True
        while changed:  # insertions
            changed = False
            for c in cells:
                best = min((after[n] + w for n, w in near[c]), default=never)
                if best < after[c]:
                    after[c], changed = best, True
        found.append(after)
    return found[::-1]


def _json_edits_by_level(symbols: list[str], amount: str) -> tuple[int, tuple[str, ...]]:
    """The fewest edits, without a bound on the search: the same moves as :func:`_json_edits` for a reader that knows only
    the bracket it is in, not the whole stack.

    A level is the place, kind and depth of an opening bracket. What lies within is searched once for all stacks around it:
    where a level closes, at what cost, is combined with everyone who opened it. So the states are bounded by a polynomial:
    pairs of symbols, times depths, times the few parser states. The heap takes the cheapest first: the cost of the cheapest way into a level,
    of what was read in it since, and what is still to come at least (:func:`_least_to_go`).
    """
    BOTTOM, START_CELL, END = 0, (OPEN, _OUT, None, False, False), "end"
    levels: list[tuple[str | None, int]] = [(None, 0)]  # kind of the bracket, its depth
    known: dict[tuple[int, str, int], int] = {}
    entered: list[int | None] = [0]  # what the cheapest way into each level costs
    callers: list[dict[tuple, tuple[int, Any]]] = [{}]  # by (level, cell to return to): cost and edits before
    closings: list[dict[tuple[int, bool], tuple[int, Any]]] = [{}]  # by (position, whether the amount was seen): cost and edits within
    heap: list = []
    done: set = set()
    serial = 0
    to_go = [(toll, _least_to_go(symbols, toll)) for toll in (0, 1, -1)]

    def push(cost: int, i: int, level: int, cell: tuple, edits: Any) -> None:
        nonlocal serial
        if (i, level, cell) not in done:
            serial += 1
            state, where = cell[:2]
            kind, depth = levels[level]
            flat = [(k, NEXT, _OUT) for k in (None, "o", "a")] if state == END else [(kind, state, where if where in (_OUT, _TEXT) else _KEY_OTHER)]
            rest = max(min(least[i][c] for c in flat) + toll * (depth - (state == END)) for toll, least in to_go)
            heapq.heappush(heap, (cost + rest, -i, serial, cost, level, cell, edits))

    def returned(cell: tuple, seen: bool) -> tuple:
        return (*cell[:4], cell[4] or seen)

    def move(cost: int, i: int, level: int, cell: tuple, symbol: str, edits: Any) -> None:
        """Read a symbol, after which the position is i."""
        state, where, number, due, seen = cell
        kind, depth = levels[level]
        outermost = depth == 1
        wrong: Any = None
        if where != _OUT:
            if symbol == '"':
                if where == _TEXT:
                    fault = due and number_fault(number, True)
                    wrong, after = fault and f"{amount} {fault}", (NEXT, _OUT, None, False, seen or due)
                else:
                    after = (COLON, _OUT, None, where == _KEY_NAMED and outermost, seen)
            else:
                if _wrong_in_string(symbol):
                    wrong = "mend the string"
                if where == _TEXT:
                    after = (state, where, number_state(number, symbol) if due else None, due, seen)
                else:
                    after = (state, _KEY_NAMED if outermost and where == _KEY_EMPTY and symbol == amount else _KEY_OTHER, None, due, seen)
        elif symbol.isspace():
            wrong, after = None if symbol.strip(" \t\n\r") == "" else "delete white space", cell
        elif level == BOTTOM and state == NEXT:
            return
        elif symbol == '"':
            if kind is None or state in (COLON, NEXT):
                return
            key = state == KEY or state == OPEN and kind == "o"
            after = (state, _KEY_EMPTY if key else _TEXT, EMPTY if due else None, due, seen)
        else:
            nxt = _fits(state, kind, symbol)
            if nxt is None:
                return
            if nxt == "(":
                if due:
                    cost, edits = cost + 1, (edits, f"{amount} is no number")
                key = (i, "o" if symbol == "{" else "a", depth + 1)
                if key not in known:
                    known[key] = len(levels)
                    levels.append(key[1:])
                    entered.append(None)
                    callers.append({})
                    closings.append({})
                inner, back = known[key], (level, (NEXT, _OUT, None, False, seen or due))
                if back in callers[inner] and callers[inner][back][0] <= cost:
                    return
                callers[inner][back] = (cost, edits)
                if entered[inner] is None:
                    push(cost, i, inner, START_CELL, None)
                for (j, saw), (more, within) in closings[inner].items():
                    push(cost + more, j, level, returned(back[1], saw), (edits, within, True))
                return
            if nxt == ")":
                push(cost, i, level, (END, _OUT, None, False, seen), edits)
                return
            if nxt == NEXT and due:
                fault = number_fault(number_state(EMPTY, json_amount(_scalar(symbol)) or ""), True)
                wrong, after = fault and f"{amount} {fault}", (NEXT, _OUT, None, False, True)
            else:
                after = (nxt, _OUT, None, due, seen)
        push(cost + bool(wrong), i, level, after, (edits, wrong) if wrong else edits)

    push(0, 0, BOTTOM, (VALUE, _OUT, None, False, False), None)
    while heap:
        _, negative, _, cost, level, cell, edits = heapq.heappop(heap)
        i = -negative
        if (i, level, cell) in done:
            continue
        done.add((i, level, cell))
        if entered[level] is None:
            entered[level] = cost  # its first cell comes before all others
        state, where, _, _, seen = cell
        if state == END:
            closings[level][i, seen] = (cost - entered[level], edits)
            for (outer, back), (before, opened) in callers[level].items():
                push(before + cost - entered[level], i, outer, returned(back, seen), (opened, edits, True))
            continue
        if i == len(symbols) and level == BOTTOM and state == NEXT:
            if seen:
                return cost, _told(edits)
            push(cost + 1, i, BOTTOM, (NEXT, _OUT, None, False, True), (edits, f"{amount} has no value"))
            continue
        if i < len(symbols):
            s = symbols[i]
            move(cost, i + 1, level, cell, s, edits)
            if s == '"' or where == _OUT and s in "{}[]:,":
                push(cost + 1, i + 1, level, cell, (edits, f"delete {s} at symbol {i}"))
            elif where == _OUT and not s.isspace():
                push(cost + 2, i + 1, level, cell, (edits, f"delete {s[:20]} at symbol {i}"))
        for mark in '"{}[]:,' if where == _OUT else '"':
            move(cost + 1, i, level, cell, mark, (edits, f"insert {mark} before symbol {i}"))
    raise AssertionError("any line can be mended")


def _told(edits: Any) -> tuple[str, ...]:
    """The edits of a list linked from its end; a link ``(before, within, True)`` has a whole list within a level."""
    said: list[str] = []
    todo = [edits]
    while todo:
        edits = todo.pop()
        if edits is None:
            continue
        if len(edits) == 3:
            todo += edits[:2]  # the later ones first
        else:
            said.append(edits[1])
            todo.append(edits[0])
    return tuple(reversed(said))


def _repair(tokens: list[str]) -> tuple[int, tuple[str, ...]]:
    """Edits of one pass from left to right: what does not fit is deleted, what is open is closed."""
    stack: list[str] = []
    state, edits, ended = VALUE, [], False
    if not tokens or tokens[0] != "{":
        edits.append("insert { before token 0")
        stack, state = ["o"], OPEN
    for i, t in enumerate(tokens):
        nxt = None if ended else _fits(state, stack[-1] if stack else None, t)
        if nxt is None:
            edits.append(f"delete {t if len(t) < 20 else t[:20]} at token {i}")
        elif nxt == "(":
            stack.append("o" if t == "{" else "a")
            state = OPEN
        elif nxt == ")":
            stack.pop()
            state, ended = NEXT, not stack
        else:
            state = nxt
    if state == KEY:
        edits.append("delete the last ,")
    elif state in (COLON, VALUE):
        edits += ["insert :"] * (state == COLON) + ["insert a value"]
    edits += [f"insert {'}' if kind == 'o' else ']'} at the end" for kind in reversed(stack)]
    return len(edits), tuple(edits)
