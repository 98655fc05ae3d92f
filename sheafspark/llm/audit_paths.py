"""The cheapest edits that repair the structure of a conversation: a dynamic program over persistent edit prefixes.

A conversation in order has the role initials ``(s?(ua)+)?``. The program walks over its rows with the state of that
pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a. The state alone tells which role an inserted or changed message
has, so the letters of the edits, the audit, tell the whole repair: K keep, R change the role, D delete, I insert.
"""

from collections.abc import Iterable

#: What the edits cost, and a truncated row that is not deleted.
CHANGE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
STATES = 4
#: The role and the state that follow an inserted or changed message.
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
#: States in which a conversation may end.
ENDS = (0, 3)
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_BASE, _MOD = 911_382_323, (1 << 61) - 1


class Edit:
    """The last letter of a prefix of edits; prefixes share what they have in common.

    ``up[j]`` is the prefix without its last 2^j letters, ``hash`` the rolling hash of all letters.
    """

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, before: "Edit | None" = None, letter: str = ""):
        self.letter = letter
        self.up: list[Edit] = []
        if before is None:
            self.depth, self.hash = 0, 0
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * _BASE + ord(letter)) % _MOD
        up, j = self.up, 0
        while True:
            up.append(before)
            if j >= len(before.up):
                return
            before, j = before.up[j], j + 1

    def prefix(self, depth: int) -> "Edit":
        node, away, j = self, self.depth - depth, 0
        while away:
            if away & 1:
                node = node.up[j]
            away, j = away >> 1, j + 1
        return node

    def letters(self) -> str:
        out, node = [], self
        while node.up:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def same(a: Edit, b: Edit) -> bool:
    """Whether two prefixes of one depth have the same letters; equal hashes are verified letter by letter."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Edit, b: Edit) -> bool:
    """Whether the letters of ``a`` come before those of ``b``, by a search for the longest common prefix."""
    depth = min(a.depth, b.depth)
    x, y = a.prefix(depth), b.prefix(depth)
    if same(x, y):
        return a.depth < b.depth
    # up to the first letter that differs: steps that stay behind it get shorter and shorter
    for j in reversed(range(len(x.up))):
        if j < len(x.up) and not same(x.up[j], y.up[j]):
            x, y = x.up[j], y.up[j]
    return x.letter < y.letter


def row_kind(initial: str, gone: bool, truncated: bool) -> int:
    """A number for what the program has to know of a row: 0 for one that must be deleted."""
    return 0 if gone else 1 + 2 * ("sua".find(initial) if initial else -1) % 8 + truncated


def _steps(kind: int) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, letters) of the best ways over a row: inserted messages, then the row's edit.

    An insertion before a deleted row is left out: the same one behind it costs as much and has the lesser letters.
    """
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(STATES):
        found[start, start] = (DELETE, "D")
        if not kind:
            continue
        initial, extra = ("sua" + " ")[(kind - 1) // 2], TRUNCATED * ((kind - 1) % 2)
        state, cost, letters = start, extra, ""
        for _ in range(3):
            ways = [(NEXT[state][1], cost + CHANGE, letters + "R")]
            if (state, initial) in _KEEP:
                ways.append((_KEEP[state, initial], cost, letters + "K"))
            for after, *way in ways:
                found[start, after] = min(found.get((start, after), tuple(way)), tuple(way))
            state, cost, letters = NEXT[state][1], cost + INSERT, letters + "I"
    return [(a, b, *way) for (a, b), way in sorted(found.items())]


STEPS = [_steps(kind) for kind in range(9)]


class Paths:
    """From one state on: the cheapest edits into every state, of equally cheap ones the least letters.

    Prefixes of equal cost that end in different states are never prefixes of each other, as each ends with the edit of
    the same row. So the lesser prefix stays the lesser, whatever follows.
    """

    def __init__(self, entry: int):
        self.best: list[tuple[int, Edit] | None] = [None] * STATES
        self.best[entry] = (0, Edit())

    def row(self, kind: int) -> None:
        chosen: list[tuple[int, Edit, str] | None] = [None] * STATES
        for before, after, cost, letters in STEPS[kind]:
            held = self.best[before]
            if held is None:
                continue
            way, now = (held[0] + cost, held[1], letters), chosen[after]
            if now is None or way[0] < now[0] or (way[0] == now[0] and less(way[1], now[1])):
                chosen[after] = way
        self.best = [None if way is None else (way[0], _with_letters(way[1], way[2])) for way in chosen]

    def ranks(self) -> list[int]:
        """Place of each state's letters among those of all states; states that cannot be reached come last."""
        order: list[int] = []
        for state, held in enumerate(self.best):
            if held is not None:
                place = sum(less(self.best[other][1], held[1]) for other in order)
                order.insert(place, state)
        return [order.index(s) if s in order else STATES for s in range(STATES)]


def _with_letters(node: Edit, letters: str) -> Edit:
    for letter in letters:
        node = Edit(node, letter)
    return node


#: Cost and letters of the messages that are inserted behind the last row, by state.
CLOSING = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}


def cheapest(kinds: Iterable[int]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation given by the kinds of its rows."""
    paths = Paths(0)
    for kind in kinds:
        paths.row(kind)
    best: tuple[int, Edit, str] | None = None
    for state, held in enumerate(paths.best):
        if held is not None:
            cost, letters = CLOSING[state]
            way = (held[0] + cost, held[1], letters)
            if best is None or way[0] < best[0] or (way[0] == best[0] and less(way[1], best[1])):
                best = way
    return best[0], best[1].letters() + best[2]


class Chain:
    """Puts segments of one conversation together: each is known by costs and ranks from every state to every state.

    The audits up to a segment's start are compared by rank only: those of different states never are prefixes of each
    other, so the lesser one decides, and within one of them the segment's own ranks decide.
    """

    def __init__(self):
        self.cost: list[int | None] = [0, None, None, None]
        self.rank = [0, STATES, STATES, STATES]
        self.came: list[bytes] = []

    def add(self, costs: list[int | None], ranks: list[int]) -> None:
        ways: list[tuple[int, int, int, int] | None] = [None] * STATES
        for after in range(STATES):
            for before in range(STATES):
                cost = costs[STATES * before + after]
                if self.cost[before] is not None and cost is not None:
                    way = (self.cost[before] + cost, self.rank[before], ranks[STATES * before + after], before)
                    ways[after] = way if ways[after] is None else min(ways[after], way)
        order = sorted((s for s in range(STATES) if ways[s]), key=lambda s: ways[s][1:3])
        self.cost = [None if w is None else w[0] for w in ways]
        self.rank = [order.index(s) if s in order else STATES for s in range(STATES)]
        self.came.append(bytes(STATES if w is None else w[3] for w in ways))

    def states(self) -> tuple[int, list[int]]:
        """The least cost, and the states before the first segment and behind each one on the way there."""
        ends = [(self.cost[s] + CLOSING[s][0], self.rank[s], s) for s in range(STATES) if self.cost[s] is not None]
        cost, _, state = min(ends)
        way = [state]
        for came in reversed(self.came):
            way.append(came[way[-1]])
        return cost, way[::-1]


class Replay:
    """Follows an audit from a state on and tells the roles of its messages."""

    def __init__(self, state: int = 0):
        self.state = state

    def role(self, letter: str, own: str = "") -> str | None:
        """The role of the message that a letter leaves; ``own`` is that of its row. None for a deleted row."""
        if letter == "D":
            return None
        if letter == "K":
            self.state = _KEEP[self.state, own[:1]]
            return own
        role, self.state = NEXT[self.state]
        return role
