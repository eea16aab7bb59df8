"""Copies hidden by formatting: bytes go through a skip-and-fold table into rolling polynomial hashes.

The table has a row for each state and a column for each byte.  An entry says which state comes next and
which symbol, if any, the byte adds to the hash; brackets round a dot, surrounding quotes, default ports,
fragments and the like add none, and letters are folded where case doesn't count.  The symbols of a host, a
path and a query come from different ranges, so where one part ends need not be written.  All rows of a
block are read side by side, one byte of each at a time; no canonical text is built.  A `..` in a path takes the hash
back to where the segment before began; addresses of IPv6 and networks are read as numbers, which are hashed.

What the table cannot read for sure (other scripts, rare spellings, malformed values) is handed to the scalar rules;
the few texts that they give are then read through the same table, so that both ways lead to the same hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions import scalar
from sightline.operators.ranges import changes, placed
from sightline.session import settled

TYPES = scalar.TYPES
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd multipliers of the two hashes modulo 2**64

# Ranges of symbols, above the byte itself. From SEG on, a symbol does more than to be added.
SCHEME, HOST, DOTTED, LOCAL, USER, PATH, QUERY, PLAIN, SEG, SEG_DOT, SEG_DOTS, BACK, TRAIL, NUMBER, DIGIT = (k << 8 for k in range(1, 16))
DEPTH = 16  # segments of a path that can be gone back over

GAP = set(b"\t\n\f\r ")
OPEN, CLOSE = set(b"[({"), set(b"])}")
DIGITS = set(b"0123456789")
ALNUM = set(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | DIGITS
NAME = ALNUM | {ord("_")}
XDIGITS = set(b"0123456789abcdefABCDEF")
PATH_PLAIN = ALNUM | set(b"-_~$&+,;=:@!'*")
USER_PLAIN = scalar.USER_KEPT | {ord(":")}
PRINTED = set(range(0x20, 0x7F))

FAIL = "fail"
# The parts of a value, and the words that brackets may hold, with the event that each stands for.
PARTS = (
    "start", "colon", "colon/", "start@", "colon@", "colon/@", "user", "host0", "host", "host-", "host.", "port", "path/", "path", "path.", "path..", "path%", "path%x", "query", "fragment", "fragment%", "fragment%x",
    "local0", "local", "hex", "prefix", "number",
)
WORDS = {".": ".", "dot": ".", "punto": ".", "point": ".", "@": "@", "at": "@", ":": ":", "/": "/", "//": "/", "://": "://"}
URL_ENDS = ("host", "port", "path/", "path", "path.", "path..", "query", "fragment")
FINAL = {"url": URL_ENDS, "domain": (*URL_ENDS, "host."), "ipv4": ("host",), "ipv6": ("number",), "cidr": ("number",), "email": ("host", "host."), "hash": ("hex",)}
COLON_, DOT_, SLASH_ = 16, 17, 18  # in NUMBER, beside the digits 0 to 15


def _event(part: str, e: str) -> tuple[str, int]:
    """(next part, symbol or 0) for one character, or '://', that has been read in a part."""
    b = ord(e) if len(e) == 1 else 0
    low = ord(e.lower()) if b else 0
    user = part.endswith("@")  # a URL with a user name: what follows the scheme
    begin = "user" if user else "host0"
    if part in ("start", "start@"):  # x and * stand for t in the schemes that are let in here
        if e in (":", "://"):
            return (("colon@" if user else "colon") if b else begin), 0
        return (part, SCHEME + (ord("t") if e in "xX*" else low)) if b in ALNUM or e == "*" else (FAIL, 0)
    if part.startswith("colon"):
        after = {"colon": "colon/", "colon@": "colon/@"}.get(part, begin)
        return (after, 0) if e == "/" else (FAIL, 0)
    if part == "user":
        return ("host0", USER + b) if e == "@" else (part, USER + b) if b in USER_PLAIN else (FAIL, 0)
    if part in ("host0", "host", "host-", "host."):
        if b in NAME:
            return "host", (DOTTED if part == "host." else HOST) + low
        if part == "host":
            goes = {"-": ("host-", HOST + b), ".": ("host.", 0), ":": ("port", 0), "/": ("path/", 0), "?": ("query", 0), "#": ("fragment", 0)}
            return goes.get(e, (FAIL, 0))
        return FAIL, 0
    if part == "port":
        goes = {"/": ("path/", 0), "?": ("query", 0), "#": ("fragment", 0)}
        return (part, DIGIT + b) if b in DIGITS else goes.get(e, (FAIL, 0))
    if part in ("path/", "path", "path.", "path.."):  # a segment's first symbol stands for the slash too; dots wait for what comes
        leaves = {"path/": TRAIL, "path..": BACK}.get(part, 0)
        if e in ("/", "?", "#"):
            return {"/": "path/", "?": "query", "#": "fragment"}[e], 0 if e == "/" and part != "path.." else leaves
        if e == "." and part in ("path/", "path."):
            return {"path/": "path.", "path.": "path.."}[part], 0
        if b in PATH_PLAIN or e in (".", "%"):
            return ("path%" if e == "%" else "path"), {"path/": SEG, "path": PATH, "path.": SEG_DOT, "path..": SEG_DOTS}[part] + b
        return FAIL, 0
    if part in ("path%", "path%x"):
        return ({"path%": "path%x", "path%x": "path"}[part], PATH + b) if b in XDIGITS else (FAIL, 0)
    if part == "query":
        return ("fragment", 0) if e == "#" else (part, QUERY + b) if b in PRINTED else (FAIL, 0)
    if part == "fragment":
        return ("fragment%", 0) if e == "%" else (part, 0) if e == "://" or b in PRINTED else (FAIL, 0)
    if part in ("fragment%", "fragment%x"):
        return ({"fragment%": "fragment%x", "fragment%x": "fragment"}[part], 0) if b in XDIGITS else (FAIL, 0)
    if part in ("local0", "local"):
        if e == "@":
            return ("host0" if part == "local" else FAIL), 0
        return ("local", LOCAL + low) if b in NAME or e in ".+-" else (FAIL, 0)
    if part == "prefix":
        return ("hex", 0) if e == ":" else (part, 0) if b in ALNUM else (FAIL, 0)
    if part == "number":
        n = int(e, 16) if b in XDIGITS else {":": COLON_, ".": DOT_, "/": SLASH_}.get(e)
        return (part, NUMBER + n) if n is not None else (FAIL, 0)
    return (part, HOST + low) if part == "hex" and b in XDIGITS else (FAIL, 0)


@lru_cache(maxsize=1)
def table() -> tuple[np.ndarray, dict[str, int]]:
    """The table, flat over state * 256 + byte: symbol * 4096 + next state; and the number of each state.

    A state is a part, or a part with what has been read of a bracket or after a backslash.
    """
    inside = {""} | {w[:i] for w in WORDS for i in range(1, len(w) + 1)}
    names = [FAIL, *PARTS, *(f"{p}\\" for p in PARTS), *(f"{p}[{x}{g}" for p in PARTS for x in sorted(inside) for g in ("", " ") if not g or x in ("", *WORDS, ":/"))]
    number = {n: i for i, n in enumerate(names)}
    flat = np.zeros((len(names), 256), np.int64)

    def put(state: str, byte: int, to: str, symbol: int = 0) -> None:
        flat[number[state], byte] = symbol * 4096 + number[to]

    for part in PARTS:
        for byte in PRINTED:
            if byte in OPEN and not part.startswith("fragment"):
                put(part, byte, f"{part}[")
            elif byte == ord("\\") and not part.startswith("fragment"):
                put(part, byte, f"{part}\\")
            else:
                put(part, byte, *_event(part, chr(byte)))
        put(f"{part}\\", ord("."), *_event(part, "."))
        for x in inside:
            for g in ("", " "):
                state = f"{part}[{x}{g}"
                if state not in number:
                    continue
                for byte in GAP:
                    if f"{part}[{x} " in number:
                        put(state, byte, f"{part}[{x} ")
                for byte in PRINTED:
                    y = x + chr(byte).lower()
                    if y in inside and not (g and y == "//"):  # no gap within a doubled slash
                        put(state, byte, f"{part}[{y}")
                if x in WORDS:
                    for byte in CLOSE:
                        put(state, byte, *_event(part, WORDS[x]))
    return flat.ravel(), number


# Which rows begin where.  W: what is trimmed; a dot, colon or slash as it is written, disarmed or not.
W = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in scalar.BLANKS + scalar.QUOTES) + "]*"
G = r"[\t\n\f\r ]*"
DOT = rf"(?:\\?\.|[\[({{]{G}(?:\.|dot|punto|point){G}[\])}}])"
AT = rf"(?:@|[\[({{]{G}(?:@|at){G}[\])}}])"
COLON = rf"(?::|[\[({{]:{G}[\])}}])"
SLASH = rf"(?:/|[\[({{]{G}//?{G}[\])}}])"
AFTER_SCHEME = rf"(?:[\[({{]:{G}/{G}/{G}[\])}}]|{COLON}{SLASH}{SLASH})"
ANY_SCHEME = rf"(?i)^{W}[a-z](?:[a-z0-9+.*\-]|{DOT})*(?:[\[({{]{G}:{G}/{G}/{G}[\])}}]|(?::|[\[({{]{G}:{G}[\])}}]){SLASH}{SLASH})"
OCTET = scalar.OCTET
QUAD = rf"{OCTET}(?:{DOT}{OCTET}){{3}}"
BITS = rf"{SLASH}(?:0|[1-9][0-9]?[0-9]?){W}$"
GROUPS = rf"(?:[0-9a-f]{{1,4}}|{COLON})*{COLON}(?:[0-9a-f]{{1,4}}|{COLON})*"
SCHEMES = {"http": r"(?:htt|hxx|hxt|htx|h\*\*)p", "https": r"(?:htt|hxx|hxt|htx|h\*\*)ps", "ftp": "f[tx]p", "tcp": "tcp", "udp": "udp", "ssh": "ssh"}


def _match(a: pa.Array, pattern: str) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(a, pattern), False).to_numpy(zero_copy_only=False)


@lru_cache(maxsize=4)
def _trimmed(characters: str) -> tuple[np.ndarray, list[bytes]]:
    """Which single bytes are trimmed, and which longer characters."""
    one = np.zeros(256, bool)
    one[[ord(c) for c in characters if ord(c) < 128]] = True
    return one, [c.encode() for c in characters if ord(c) >= 128]


class Numbers:
    """IPv6 addresses and networks, read a digit or mark at a time; the same number is the same address."""

    def __init__(self, n: int, four: np.ndarray):
        self.four = four  # dotted, in tens; others in sixteens
        self.groups = np.zeros((n, 9), np.int64)
        self.at, self.cur, self.size, self.double, self.bits = (np.full(n, x, np.int64) for x in (0, 0, 0, -1, -1))
        self.last = np.full(n, -1, np.int64)  # the last mark, if nothing came after it
        self.bad = np.zeros(n, bool)

    def step(self, rows: np.ndarray, what: np.ndarray) -> None:
        digit = what < 16
        r, v = rows[digit], what[digit]
        inside = self.bits[r] >= 0
        q, w = r[inside], v[inside]
        self.bits[q] = np.minimum(self.bits[q] * 10 + w, 999)
        self.bad[q] |= w > 9
        q, w = r[~inside], v[~inside]
        self.cur[q] = self.cur[q] * np.where(self.four[q], 10, 16) + w
        self.size[q] += 1
        self.bad[q] |= self.size[q] > 4
        self.last[r] = -1
        r, v = rows[~digit], what[~digit]
        self.bad[r] |= (self.bits[r] >= 0) | ((v == DOT_) != self.four[r]) & (v != SLASH_) | (self.last[r] == DOT_)
        again = (v == COLON_) & (self.last[r] == COLON_)
        self.bad[r] |= again & (self.double[r] >= 0) | (v == SLASH_) & (self.last[r] == COLON_) & (self.double[r] != self.at[r])
        self.double[r[again]] = self.at[r[again]]
        lone = (self.size[r] == 0) & (v == COLON_) & ~again & (self.at[r] > 0)  # a group without digits
        self.bad[r] |= lone & (self.last[r] != COLON_)
        self._push(r[self.size[r] > 0])
        self.bits[r[v == SLASH_]] = 0
        self.last[r] = v

    def _push(self, r: np.ndarray) -> None:
        at = np.minimum(self.at[r], 8)
        self.groups[r, at] = self.cur[r]
        self.at[r], self.cur[r], self.size[r] = at + 1, 0, 0

    def done(self, network: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row: version, eight groups (of a network, without host bits) and the bits; and whether it is well-formed."""
        plain = self.bits < 0
        self.bad |= plain & ((self.last == DOT_) | (self.last == COLON_) & (self.double != self.at)) | (self.last == SLASH_)
        self._push(np.flatnonzero(self.size > 0))
        first = self.first_colon
        want = np.where(self.four, 4, 8)
        open_ = self.double >= 0
        self.bad |= first | (self.at > want) | (~open_ & (self.at != want)) | (open_ & (self.at >= want)) | (plain == network) | (self.bits > np.where(self.four, 32, 128))
        out = np.zeros((len(self.at), 10), np.int64)
        out[:, 0], out[:, 9] = np.where(self.four, 4, 6), self.bits
        behind = np.where(open_, self.at - self.double, 0)
        for i in range(8):
            from_ = np.where(i >= 8 - behind, i - 8 + self.at, np.where(open_ & (i >= self.double), 8, i))
            out[:, 1 + i] = np.where(from_ < self.at, self.groups[np.arange(len(self.at)), np.minimum(from_, 8)], 0)
        width = np.where(self.four, 8, 16)
        for i in range(8):
            left = np.where(network, np.clip(self.bits - i * width, 0, width), width)
            out[:, 1 + i] &= ((1 << width) - 1) ^ ((1 << (width - left)) - 1)
        mapped = ~self.four & ~network & (out[:, 1:6] == 0).all(1) & (out[:, 6] == 0xFFFF)  # is IPv4
        return out, ~self.bad & ~mapped


class Reader:
    """The rows of a block, each with its type, the state to begin in and its bytes; `known` where the table will do.
    Texts that are `canonical` are taken as they are: nothing is trimmed, no scheme replaced."""

    def __init__(self, kind: pa.Array, raw: pa.Array, canonical: bool = False):
        _, number = table()
        n = len(raw)
        kind = pc.fill_null(kind, "auto")
        kind = pc.if_else(pc.equal(kind, ""), "auto", kind)
        raw = pc.fill_null(raw, "").cast(pa.large_string())
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + n + 1]
        self.flat = np.r_[np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] else np.zeros(0, np.uint8), np.zeros(4, np.uint8)]
        self.start, self.end = offsets[:-1].copy(), offsets[1:].copy()
        moved = self.start
        if not canonical:
            self._trim(scalar.BLANKS)
            self._trim(scalar.QUOTES)
            moved = self.start.copy()
            self._trim(scalar.BLANKS)
        inner = self.start > moved  # blanks within the quotes: the scheme isn't at the front

        t = {k: pc.equal(kind, k).to_numpy(zero_copy_only=False) for k in ("auto", *TYPES)}
        self.type = np.full(n, -1, np.int64)
        self.state = np.zeros(n, np.int64)
        self.port = np.zeros(n, np.int64)
        self.seed = np.zeros(n, np.int64)
        self.four = np.zeros(n, bool)
        size = self.end - self.start
        free = np.ones(n, bool)

        def give(rows: np.ndarray, what: str, state: str) -> np.ndarray:
            rows = rows & free
            self.type[rows], self.state[rows] = TYPES.index(what), number[state]
            free[rows] = False
            return rows

        for algorithm, length in scalar.HEX_LENGTH.items():
            bare = _match(raw, rf"^{W}[0-9a-fA-F]{{{length}}}{W}$")
            give(bare & (t["auto"] | t[algorithm]), algorithm, "hex")
            give(t[algorithm] & _match(raw, rf"(?i)^{W}{algorithm}:[0-9a-f]{{{length}}}{W}$"), algorithm, "prefix")
        any_scheme = _match(raw, ANY_SCHEME)
        at, slash = _match(raw, f"(?i){AT}"), _match(raw, SLASH)
        user = at & _match(raw, rf"(?i)^{W}(?:[a-z*]+{AFTER_SCHEME})?[^/?#]*{AT}")
        short = (size <= 253) & ~_match(raw, r"[a-zA-Z0-9_\-]{64}")
        for scheme, spelt in SCHEMES.items():
            begins = any_scheme & ~inner & _match(raw, rf"(?i)^{W}{scheme if canonical else spelt}{AFTER_SCHEME}")
            mine = (t["auto"] | t["url"]) & begins
            self.port[give(mine & ~user, "url", "start") | give(mine & user, "url", "start@")] = int(scalar.DEFAULT_PORT.get(scheme, -1))
            give(t["domain"] & short & begins & ~at, "domain", "start")
        free &= ~(any_scheme & (t["auto"] | t["url"] | t["domain"]))
        give((t["auto"] | t["ipv4"]) & _match(raw, rf"(?i)^{W}{QUAD}{W}$"), "ipv4", "host0")
        self.start[give((t["auto"] | t["ipv4"]) & _match(raw, rf"(?i)^{W}::ffff:{QUAD}{W}$"), "ipv4", "host0")] += 7
        give((t["auto"] | t["ipv6"]) & _match(raw, rf"(?i)^{W}{GROUPS}{W}$"), "ipv6", "number")
        nets = t["auto"] | t["cidr"]
        self.four |= give(nets & _match(raw, rf"(?i)^{W}{QUAD}{BITS}"), "cidr", "number")
        give(nets & _match(raw, rf"(?i)^{W}{GROUPS}{BITS}"), "cidr", "number")
        give((t["auto"] | t["email"]) & at & short, "email", "local0")
        network = t["auto"] & _match(raw, rf"(?i)^{W}[0-9a-f:.]+(?:{DOT}[0-9]+)*{SLASH}[0-9]+{W}$")
        for has in (True, False):
            rows = give(((t["auto"] & ~at & slash & ~network) | t["url"]) & ~any_scheme & (user == has), "url", "user" if has else "host0")
            self.port[rows], self.seed[rows] = 80, 1  # as if it began with http://
        give(t["domain"] & short & ~at, "domain", "host0")
        give(t["auto"] & short & ~at & ~slash & ~_match(raw, r"[?#:]"), "domain", "host0")
        self.known = ~free & (size > 0)
        self.finals = np.zeros((len(TYPES) + 1, len(number)), bool)
        for i, x in enumerate(TYPES):
            for p in FINAL.get("hash" if x in scalar.HEX_LENGTH else x, ()):
                self.finals[i, number[p]] = True

    def _trim(self, characters: str) -> None:
        """Move the ends of all rows in, over these characters."""
        one, longer = _trimmed(characters)
        flat, live = self.flat, np.arange(len(self.start))
        while len(live):
            s, e = self.start[live], self.end[live]
            front, back = one[flat[s]].astype(np.int64), one[flat[e - 1]].astype(np.int64)
            if (flat[s] > 127).any() or (flat[e - 1] > 127).any():
                for c in longer:
                    w = len(c)
                    room = e - s >= w
                    front[room & np.logical_and.reduce([flat[s + i] == c[i] for i in range(w)])] = w
                    back[room & np.logical_and.reduce([flat[e - w + i] == c[i] for i in range(w)])] = w
            front[e <= s] = 0
            self.start[live] += front
            back[self.end[live] - self.start[live] < np.maximum(back, 1)] = 0
            self.end[live] -= back
            live = live[(front + back) > 0]

    def accepted(self, kinds: np.ndarray, state: np.ndarray, dots: np.ndarray, lead: np.ndarray, port: np.ndarray, zero: np.ndarray) -> np.ndarray:
        """Whether what has been read is whole, by its type, the state it ended in, its dots, the first byte of its last
        label (a name doesn't end in a number) and its port."""
        domain = kinds == TYPES.index("domain")
        named = domain | (kinds == TYPES.index("email"))
        return self.finals[kinds, state] & (domain | ~zero & (port < 10**6)) & (~named | ((dots > 0) & (lead >= ord("a")) & (lead <= ord("z"))))

    def hashes(self, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each row's symbols, and whether the table could read the row to its end. `numbers`: what
        addresses and networks are, by row."""
        flat, number = table()
        order = np.flatnonzero(self.known if only is None else self.known & only)
        order = order[np.argsort(self.start[order] - self.end[order], kind="stable")]  # the longest first
        at, size = self.start[order], (self.end - self.start)[order]
        state, kinds = self.state[order], self.type[order]
        h = [np.full(len(order), b ^ 0x5851F42D4C957F2D, np.uint64) for b in BASES]
        web = self.seed[order] == 1
        for k, b in enumerate(BASES):  # what the scheme http would have added
            x = h[k][web]
            for c in b"http":
                x = x * np.uint64(b) + np.uint64(SCHEME + c)
            h[k][web] = x
        port, dots, lead, depth = (np.zeros(len(order), np.int64) for _ in range(4))
        zero, bad = np.zeros(len(order), bool), np.zeros(len(order), bool)
        domain = kinds == TYPES.index("domain")
        saved = [np.zeros((DEPTH, len(order)), np.uint64) for _ in BASES]
        numeric = np.isin(kinds, [TYPES.index("ipv6"), TYPES.index("cidr")])
        place = np.cumsum(numeric) - 1
        numbers = Numbers(int(numeric.sum()), self.four[order][numeric])
        numbers.first_colon = self._first_colon(order[numeric])
        live = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        for j, n in enumerate(live):
            entry = flat[state[:n] * 256 + self.flat[at[:n] + j]]
            state[:n] = entry & 4095
            symbol = entry >> 12
            kind = symbol & ~255
            dotted = kind == DOTTED
            dots[:n] += dotted
            lead[:n] = np.where(dotted, symbol & 255, lead[:n])
            adds = (symbol > 0) & (~domain[:n] | dotted | (kind == HOST))
            more = np.flatnonzero(kind >= SEG)
            if len(more):
                what = kind[more]
                digit, num, back = more[what == DIGIT], more[what == NUMBER], more[what == BACK]
                zero[digit] |= (port[digit] == 0) & (symbol[digit] == DIGIT + ord("0"))
                port[digit] = np.minimum(port[digit] * 10 + symbol[digit] - DIGIT - 48, 10**6)
                if len(num):
                    numbers.step(place[num], symbol[num] & 255)
                seg = more[what <= SEG_DOTS]
                bad[seg] |= depth[seg] >= DEPTH
                d = np.minimum(depth[seg], DEPTH - 1)
                for x, y in zip(h, saved):
                    y[d, seg] = x[seg]
                depth[seg] = d + 1
                back = back[depth[back] > 0]
                depth[back] -= 1
                for x, y in zip(h, saved):
                    x[back] = y[depth[back], back]
                adds[more[what >= BACK]] = False
                trail = more[(what == TRAIL) & (depth[more] > 0)]
                adds[trail] = ~domain[trail]
            s = symbol.astype(np.uint64)
            for x, b in zip(h, BASES):
                x[:n] = np.where(adds, x[:n] * np.uint64(b) + s, x[:n])
        back = np.flatnonzero((state == number["path.."]) & (depth > 0))
        trail = np.flatnonzero((state == number["path/"]) & (depth > 0) & ~domain)
        for x, y, b in zip(h, saved, BASES):
            x[back] = y[depth[back] - 1, back]
            x[trail] = x[trail] * np.uint64(b) + np.uint64(TRAIL)
        ok = self.accepted(kinds, state, dots, lead, port, zero) & ~bad
        port[(port == self.port[order]) | domain] = 0
        values, fine = numbers.done(kinds[numeric] == TYPES.index("cidr"))
        ok[numeric] &= fine
        for x, b in zip(h, BASES):
            for column in values.T:
                x[numeric] = x[numeric] * np.uint64(b) + (column + NUMBER).astype(np.uint64)
        out = [np.zeros(len(self.known), np.uint64) for _ in BASES]
        for x, b, o in zip(h, BASES, out):
            x = (x * np.uint64(b) + port.astype(np.uint64)) * np.uint64(b) + kinds.astype(np.uint64)
            x ^= x >> np.uint64(29)
            o[order] = x * np.uint64(0xBF58476D1CE4E5B9)
        read = np.zeros(len(self.known), bool)
        read[order[ok]] = True
        self.numbers = np.zeros((len(self.known), 10), np.int64)
        self.numbers[order[numeric]] = values
        return out[0], out[1], read

    def _first_colon(self, rows: np.ndarray) -> np.ndarray:
        """Whether an address begins with a single colon, or with one that is disarmed."""
        flat, s = self.flat, self.start[rows]
        return np.isin(flat[s], list(OPEN)) | (flat[s] == ord(":")) & (flat[s + 1] != ord(":"))


def _plain(kind: str, value: str) -> tuple[int, int]:
    """Hashes of a canonical text that the table can't read."""
    out = []
    for b in BASES:
        x = TYPES.index(kind) + 1
        for c in value.encode("utf-8", "surrogatepass"):
            x = (x * b + PLAIN + c) & (2**64 - 1)
        x ^= x >> 29
        out.append(x * 0xBF58476D1CE4E5B9 & (2**64 - 1))
    return out[0], out[1]


def fingerprints(kind: pa.Array, raw: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each value, equal for equal canonical type and value, and whether it has a canonical form."""
    a, b, read = Reader(kind, raw).hashes()
    rest = np.flatnonzero(~read)
    valid = read.copy()
    if len(rest):
        take = pa.array(rest)
        seen: dict[tuple, tuple | None] = {}
        pairs = list(zip(kind.take(take).to_pylist(), raw.take(take).to_pylist()))
        for p in pairs:
            if p not in seen:
                seen[p] = scalar.observable(*p)
        forms = sorted({x for x in seen.values() if x is not None})
        if forms:
            fa, fb, fread = Reader(pa.array([x[0] for x in forms]), pa.array([x[1] for x in forms]), canonical=True).hashes()
            # brackets and backslashes that are still there are text; the table never lets them through
            by = {x: (int(fa[i]), int(fb[i])) if fread[i] and not set("[({\\") & set(x[1]) else _plain(*x) for i, x in enumerate(forms)}
            for i, p in zip(rest.tolist(), pairs):
                if seen[p] is not None:
                    a[i], b[i] = by[seen[p]]
                    valid[i] = True
    return a, b, valid


def same(kind_a: pa.Array, raw_a: pa.Array, kind_b: pa.Array, raw_b: pa.Array) -> np.ndarray:
    """Whether the values of each row are equal apart from formatting: two cursors, each skipping on to its next
    symbol, which are compared; all rows at once; addresses and networks are compared as numbers.  Texts that are the
    same need no reading; pairs that the table can't read to their ends alike (where a path goes back by `..`, too) are
    compared by the scalar rules."""
    flat, number = table()
    out = pc.and_(pc.fill_null(pc.equal(raw_a, raw_b), False), pc.equal(pc.fill_null(kind_a, "auto"), pc.fill_null(kind_b, "auto"))).to_numpy(zero_copy_only=False).copy()
    rest = np.flatnonzero(~out)
    if not len(rest):
        return out
    take = pa.array(rest)
    sides = [(k.take(take), r.take(take)) for k, r in ((kind_a, raw_a), (kind_b, raw_b))]
    rs = [Reader(*x) for x in sides]
    rows = np.flatnonzero(rs[0].known & rs[1].known & (rs[0].type == rs[1].type) & (rs[0].seed == rs[1].seed))
    at = [r.start[rows].copy() for r in rs]
    end = [r.end[rows] for r in rs]
    state = [r.state[rows].copy() for r in rs]
    port, dots, lead = ([np.zeros(len(rows), np.int64) for _ in rs] for _ in range(3))
    domain = rs[0].type[rows] == TYPES.index("domain")
    zero = np.zeros(len(rows), bool)
    got = [np.full(len(rows), -1, np.int64) for _ in rs]  # -1: none yet; 0: at the end
    equal, live = np.ones(len(rows), bool), np.arange(len(rows))
    while len(live):
        for k in (0, 1):
            want = live[got[k][live] < 0]
            done = at[k][want] >= end[k][want]
            got[k][want[done]] = 0
            want = want[~done]
            entry = flat[state[k][want] * 256 + rs[k].flat[at[k][want]]]
            at[k][want] += 1
            state[k][want] = entry & 4095
            symbol = entry >> 12
            kind = symbol & ~255
            digit, dotted = kind == DIGIT, kind == DOTTED
            zero[want[digit]] |= (port[k][want[digit]] == 0) & (symbol[digit] == DIGIT + ord("0"))
            port[k][want[digit]] = np.minimum(port[k][want[digit]] * 10 + symbol[digit] - DIGIT - 48, 10**6)
            dots[k][want] += dotted
            lead[k][want[dotted]] = symbol[dotted] & 255
            some = (symbol > 0) & ~digit & (~domain[want] | dotted | (kind == HOST))
            got[k][want[some]] = symbol[some]
        both = live[(got[0][live] >= 0) & (got[1][live] >= 0)]
        equal[both] &= got[0][both] == got[1][both]
        over = (got[0][both] == 0) | ~equal[both]
        live = np.setdiff1d(live, both[over], assume_unique=True) if over.any() else live
        for k in (0, 1):
            got[k][both[~over]] = -1
    for k in (0, 1):
        ends = np.where(state[k] == number["path/"], state[1 - k] == number["path/"], True)  # both or none end in a slash
        equal &= rs[k].accepted(rs[k].type[rows], state[k], dots[k], lead[k], port[k], zero) & (ends | domain) & (state[k] != number["path.."])
        port[k][(port[k] == rs[k].port[rows]) | domain] = 0
    fine = np.zeros(len(rest), bool)
    fine[rows] = equal & (port[0] == port[1])
    numeric = np.isin(rs[0].type, [TYPES.index("ipv6"), TYPES.index("cidr")]) & (rs[0].type == rs[1].type)
    if numeric.any():
        read = [r.hashes(numeric)[2] for r in rs]
        fine[numeric] = (read[0] & read[1] & (rs[0].numbers == rs[1].numbers).all(1))[numeric]
    ask = np.flatnonzero(~fine)
    if len(ask):
        take = pa.array(ask)
        a, b = ([scalar.observable(*x) for x in zip(k.take(take).to_pylist(), r.take(take).to_pylist())] for k, r in sides)
        fine[ask] = [x is not None and x == y for x, y in zip(a, b)]
    out[rest] = fine
    return out


def _hashed(df: DataFrame, row_id: str, kind: Column, raw: Column, bits: int) -> DataFrame:
    """id, kind, raw, a, b: the rows whose value has a canonical form, with its two hashes; read and written once."""
    rows = df.select(F.col(row_id).cast("long").alias("id"), kind.alias("kind"), raw.alias("raw"))
    mask = np.uint64(2**bits - 1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, valid = fingerprints(batch.column(1), batch.column(2))
            full = pa.RecordBatch.from_arrays([*batch.columns, pa.array((a & mask).view(np.int64)), pa.array((b & mask).view(np.int64))], names=["id", "kind", "raw", "a", "b"])
            yield full.filter(pa.array(valid))

    return settled(rows.mapInArrow(read, "id long, kind string, raw string, a long, b long"))


FOUND = {"what": "string", "part": "int", "keep_id": "long", "id": "long", "n": "long", "kind": "string", "raw": "string", "a": "long", "b": "long"}
ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}


def _runs(hashed: DataFrame, members: bool) -> DataFrame:
    """Rows of equal hashes, put together where they lie after a shuffle by ranges of (hashes, id), settled.

    what = 'row' (with `members`): a row and the one it is kept as, the first of its stretch; 'run' (without): that
    one, and how many rows of the stretch are its copies; 'astray': a row that differs from it after all; 'first' and
    'last': those kept of a partition's first and last stretch, of which the next and the last partition may hold more.
    """

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: pa.RecordBatch | None = None  # the row that is kept of the stretch still open, and its copies so far
        copies_held = 0

        def out(what: str, size: int, **columns: pa.Array) -> pa.RecordBatch:
            columns |= {"what": pa.array([what] * size, pa.string()), "part": pa.array(np.full(size, part, np.int32))}
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(size, ARROW[t])).cast(ARROW[t]) for c, t in FOUND.items()], names=list(FOUND))

        def edge(what: str, row: pa.RecordBatch) -> pa.RecordBatch:
            return out(what, 1, keep_id=row.column(0), **dict(zip(("kind", "raw", "a", "b"), row.columns[1:])))

        for batch in batches:
            if not batch.num_rows:
                continue
            old = held is not None
            if old:
                batch = pa.Table.from_batches([held.cast(batch.schema), batch]).combine_chunks().to_batches()[0]
            ids, kinds, raws, a, b = batch.columns
            new = changes(a) | changes(b)
            starts = np.flatnonzero(new)
            if not old:
                yield edge("first", batch.slice(0, 1))
            kept = starts[np.cumsum(new) - 1]
            rest = np.flatnonzero(~new)
            ok = np.ones(len(ids), bool)
            i, j = pa.array(kept[rest]), pa.array(rest)
            ok[rest] = same(kinds.take(i), raws.take(i), kinds.take(j), raws.take(j))
            bad = np.flatnonzero(~ok)
            if len(bad):
                j = pa.array(bad)
                yield out("astray", len(bad), id=ids.take(j), a=a.take(j), b=b.take(j))
            if members:
                j = np.flatnonzero(ok)[int(old) :]
                yield out("row", len(j), keep_id=ids.take(pa.array(kept[j])), id=ids.take(pa.array(j)))
            n = np.add.reduceat(ok.astype(np.int64), starts)
            n[0] += copies_held - old
            if not members and len(starts) > 1:
                j = pa.array(starts[:-1])
                yield out("run", len(j), keep_id=ids.take(j), n=pa.array(n[:-1]), kind=kinds.take(j), raw=raws.take(j))
            held, copies_held = batch.slice(int(starts[-1]), 1), int(n[-1])
        if held is not None:
            yield edge("last", held)
            if not members:
                yield out("run", 1, keep_id=held.column(0), n=pa.array([copies_held]), kind=held.column(1), raw=held.column(2))

    return settled(placed(hashed, "a", "b", "id").mapInArrow(group, ", ".join(f"{c} {t}" for c, t in FOUND.items())))


def _stitched(found: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """keep_id, true_id of the rows kept at partitions' edges that are copies of one kept before; and the hashes (a, b)
    that different values have, null if none do. Two rows a partition come to the driver."""
    spark = found.sparkSession
    true: list[tuple[int, int]] = []
    mixed: list[tuple[int, int]] = []
    open_ = None
    for r in sorted(found.where(F.col("what").isin("first", "last")).collect(), key=lambda r: (r["part"], r["what"])):
        here = open_ is not None and (r["a"], r["b"]) == (open_["a"], open_["b"])
        if here and r["what"] == "first":
            one = lambda x: pa.array([x], pa.string())
            if same(one(open_["kind"]), one(open_["raw"]), one(r["kind"]), one(r["raw"]))[0]:
                true.append((r["keep_id"], open_["keep_id"]))
            else:
                mixed.append((r["a"], r["b"]))
        if not here:
            open_ = r
    collided = found.where("what = 'astray'").select("a", "b")
    if mixed or not collided.isEmpty():
        collided = collided.unionByName(spark.createDataFrame(mixed, "a long, b long")).distinct()
    else:
        collided = None
    return spark.createDataFrame(true, "stretch_id long, true_id long"), collided


def _by_text(hashed: DataFrame, collided: DataFrame) -> DataFrame:
    """keep_id, id, kind, raw: the rows whose hashes different values have, grouped by their canonical text instead."""

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = ["\0".join(scalar.observable(*x)) for x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forms, pa.string())], names=["id", "kind", "raw", "form"])

    rows = settled(hashed.join(collided, ["a", "b"], "left_semi").select("id", "kind", "raw").mapInArrow(text, "id long, kind string, raw string, form string"))
    return rows.join(rows.groupBy("form").agg(F.min("id").alias("keep_id")), "form").select("keep_id", "id", "kind", "raw")


def collapsed(df: DataFrame, row_id: str, kind: Column, raw: Column, bits: int = 64) -> DataFrame:
    """row_id, type, raw_value, n_copies: each observable once, as its smallest row_id writes it, with the number of
    its rows. Values without a canonical form are left out; an empty table gives no rows. See `copies`."""
    hashed = _hashed(df, row_id, kind, raw, bits)
    found = _runs(hashed, members=False)
    true, collided = _stitched(found)
    runs = found.where("what = 'run'").select("keep_id", "n", "kind", "raw")
    if collided is not None:
        again = _by_text(hashed, collided)
        n = again.groupBy("keep_id").agg(F.count("*").alias("n"))
        first = again.where("id = keep_id").join(n, "keep_id").select("keep_id", "n", "kind", "raw")
        runs = runs.join(again.select(F.col("id").alias("keep_id")), "keep_id", "left_anti").unionByName(first)
        true = true.join(again.select(F.col("id").alias("stretch_id")), "stretch_id", "left_anti")
    # stretches that go on from another partition (one a partition at most) add to what they belong to
    runs = runs.join(F.broadcast(true), F.col("keep_id") == F.col("stretch_id"), "left")
    more = runs.where("true_id is not null").groupBy(F.col("true_id").alias("to_id")).agg(F.sum("n").alias("more"))
    whole = runs.where("true_id is null").join(F.broadcast(more), F.col("keep_id") == F.col("to_id"), "left")
    return whole.select(F.col("keep_id").alias(row_id), F.col("kind").alias("type"), F.col("raw").alias("raw_value"), (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_copies"))


def copies(df: DataFrame, row_id: str, kind: Column, raw: Column, bits: int = 64) -> DataFrame:
    """keep_id, row_id: each row that is a copy of another, with the smallest row_id of its group.

    Rows are copies if their canonical type and value are equal.  Values that have no canonical form (null and
    blank ones too) are in no group.  The row that is kept isn't listed under itself.  row_id must be unique.
    An empty table gives no rows.

    The table is read and hashed once, and shuffled once, by sampled ranges of (hashes, row_id): a group of any size
    spans as many partitions as its rows need, in order.  Each row is compared with the first of its stretch, and the
    first of a stretch that goes on from the partition before with the one kept there.  If a row differs after
    all (two hashes collided), the rows of these hashes are grouped by their canonical text instead.  `bits` of each
    hash are used; fewer serve to test that.
    """
    hashed = _hashed(df, row_id, kind, raw, bits)
    found = _runs(hashed, members=True)
    true, collided = _stitched(found)
    pairs = found.where("what = 'row'").select("keep_id", "id")
    if collided is not None:
        again = _by_text(hashed, collided).select("keep_id", "id")
        pairs = pairs.join(again.select("id"), "id", "left_anti").unionByName(again)
        true = true.join(again.select(F.col("id").alias("stretch_id")), "stretch_id", "left_anti")
    pairs = pairs.join(F.broadcast(true), F.col("keep_id") == F.col("stretch_id"), "left")  # at most one a partition
    return pairs.select(F.coalesce("true_id", "keep_id").alias("keep_id"), F.col("id").alias(row_id)).where(F.col("keep_id") != F.col(row_id))
