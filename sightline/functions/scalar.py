"""Canonical forms, one value at a time, in plain Python.

This is the complete rule set.  `columns.py` expresses the common cases as Spark columns and sends only
what those cannot express here.  Every function returns None where a value has no canonical form.
"""

from __future__ import annotations

import ipaddress
import re
import unicodedata
from functools import lru_cache

try:
    import idna as _idna
except ImportError:  # only names beyond ASCII need it
    _idna = None

# White space that is trimmed, quoting characters, digest lengths, default ports, kinds of observable.
BLANKS = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
QUOTES = "<>\"'`"
HEX_LENGTH = {"md5": 32, "sha1": 40, "sha256": 64, "sha512": 128}
DEFAULT_PORT = {"http": "80", "https": "443", "ftp": "21", "ssh": "22"}
TYPES = ("ipv4", "ipv6", "cidr", "domain", "url", "email", *HEX_LENGTH)

# Fixed patterns: what disarmed values are written with, in the order in which they are undone.
GAP = r"[\t\n\f\r ]*"
OPEN, CLOSE = r"[\[({]", r"[\])}]"
SCHEME_ALIAS = re.compile(r"\A(?:(h(?:xxp|xtp|\*\*p)|htxp)(s?)|fxp)(?=[\[({]?:)", re.I)
DISARMED = (
    (re.compile(f"{OPEN}{GAP}:{GAP}/{GAP}/{GAP}{CLOSE}"), "://"),
    (re.compile(f"{OPEN}{GAP}(?:\\.|dot|punto|point){GAP}{CLOSE}", re.I), "."),
    (re.compile(f"{OPEN}{GAP}(?:@|at){GAP}{CLOSE}", re.I), "@"),
    (re.compile(f"{OPEN}{GAP}:{GAP}{CLOSE}"), ":"),
    (re.compile(f"{OPEN}{GAP}//?{GAP}{CLOSE}"), "/"),
    (re.compile(r"\\\."), "."),
)

HAS_SCHEME = re.compile(r"\A[a-zA-Z][a-zA-Z0-9+.\-]*://")
HEX = re.compile(r"\A[0-9a-fA-F]+\Z")
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
DOTTED = re.compile(rf"\A{OCTET}(?:\.{OCTET}){{3}}\Z")
BITS = re.compile(r"\A(?:0|[1-9][0-9]{0,2})\Z")
PORT = re.compile(r"\A[+-]?[0-9]+\Z")
LABEL = re.compile(r"\A[a-z0-9_-]{1,63}\Z")
CVE = re.compile(r"\ACVE-([0-9]{4})-([0-9]{4,})\Z")

UNRESERVED = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_.~")
PATH_KEPT = UNRESERVED | frozenset(b"$&+,/:;=@")  # left as they are when a path is written anew
PATH_LEGAL = PATH_KEPT | frozenset(b"!'()*[]%")  # a path of these only is kept as it was written
USER_KEPT = UNRESERVED | frozenset(b"$&+,;=")
USER_LEGAL = UNRESERVED | frozenset(b"!$&'()*+,;=%@:")
HOST_LEGAL = UNRESERVED | frozenset(b"!$&'()*+,;=:[]<>\"")


def defang(raw: str | None) -> str:
    """Undo the spellings by which a value was disarmed; '' for null and blank."""
    v = (raw or "").strip(BLANKS).strip(QUOTES)
    v = SCHEME_ALIAS.sub(lambda m: "ftp" if m[1] is None else "http" + m[2].lower(), v)
    if any(c in v for c in "[({\\"):
        for pattern, plain in DISARMED:
            v = pattern.sub(plain, v)
    return v.strip(BLANKS)


def parse_ip(text: str):
    """An address, IPv4 if it is mapped into IPv6; a zone is left out."""
    text = text.partition("%")[0]
    if DOTTED.match(text):
        return ipaddress.IPv4Address(text)
    if ":" not in text:
        return None
    try:
        ip = ipaddress.IPv6Address(text)
    except ValueError:
        return None
    return ip.ipv4_mapped or ip


def parse_network(text: str) -> str | None:
    """address/bits with the host bits cleared."""
    address, slash, bits = text.rpartition("/")
    if not slash or "%" in address or not BITS.match(bits):
        return None
    if DOTTED.match(address):
        return str(ipaddress.IPv4Network(f"{address}/{bits}", strict=False)) if int(bits) <= 32 else None
    if ":" not in address or int(bits) > 128:
        return None
    try:
        net = ipaddress.IPv6Network(f"{address}/{bits}", strict=False)
    except ValueError:
        return None
    return f"{net.network_address}/{bits}"


def _mapped(host: str) -> str | None:
    if _idna is None:  # any other mapping would give one host different keys on different machines
        raise RuntimeError("the package idna is needed for international names")
    try:
        return _idna.uts46_remap(host, std3_rules=False, transitional=False)
    except _idna.IDNAError:
        return None


def _label_ok(label: str) -> bool:
    if label[:1] == "-" or label[-1:] == "-" or (len(label) > 4 and label[2:4] == "--"):
        return False
    if label.isascii():
        return True
    if unicodedata.category(label[0]).startswith("M"):
        return False
    return all(c not in "\u200c\u200d" or (i and unicodedata.combining(label[i - 1]) == 9) for i, c in enumerate(label))


@lru_cache(maxsize=65536)
def ascii_host(host: str) -> str | None:
    """Lower case, in the ASCII form of internationalised names; underscores are allowed."""
    host = host.lower() if host.isascii() else _mapped(host)
    if host is None:
        return None
    labels = []
    for label in host.split("."):
        if label.startswith("xn--"):
            try:
                plain = label[4:].encode("ascii").decode("punycode")
            except (UnicodeError, ValueError):
                return None
            if not plain or plain.isascii() or unicodedata.normalize("NFC", plain) != plain or _mapped(plain) != plain:
                return None
            label = plain
        if label and not _label_ok(label):
            return None
        labels.append(label if label.isascii() else "xn--" + label.encode("punycode").decode("ascii"))
    return ".".join(labels)


def host_form(host: str) -> str | None:
    """Canonical host: an address, or the ASCII form of a name."""
    host = host.strip("[]")
    ip = parse_ip(host)
    return str(ip) if ip is not None else ascii_host(host)


def is_domain(host: str) -> bool:
    return len(host) <= 253 and "." in host and all(LABEL.match(x) for x in host.split("."))


def split_port(authority: str) -> tuple[str, str] | None:
    """(host, port); None for an address in brackets that doesn't end. What isn't a port stays in the host."""
    if authority.startswith("["):
        inside, closed, rest = authority[1:].rpartition("]")
        return (inside, rest[1:] if rest.startswith(":") else "") if closed else None
    host, colon, port = authority.rpartition(":")
    if not colon or ":" in host or (port and not PORT.match(port)):
        return authority, ""
    return host, port


def _decoded(text: str, strict_host: bool = False) -> bytes | None:
    """Percent escapes undone; None if one is malformed (in a host, if it hides an ASCII character)."""
    first, *rest = text.encode("utf-8", "surrogatepass").split(b"%")
    out = [first]
    for part in rest:
        code = part[:2]
        if len(code) < 2 or not HEX.match(code.decode("latin1")):
            return None
        if strict_host and int(code, 16) < 128 and code != b"25":
            return None
        out += [bytes([int(code, 16)]), part[2:]]
    return b"".join(out)


def _escaped(data: bytes, kept: frozenset) -> str:
    return "".join(chr(b) if b in kept else f"%{b:02X}" for b in data)


def parse_url(text: str) -> tuple[str, str | None, str, str, str] | None:
    """(scheme, user part, host with port, path in its escaped form, query); None if malformed."""
    if any(c < " " or c == "\x7f" for c in text):
        return None
    text, _, fragment = text.partition("#")
    if _decoded(fragment) is None:
        return None
    scheme, _, rest = text.partition("://")
    rest, _, query = rest.partition("?")
    authority, slash, path = rest.partition("/")
    path = slash + path
    user, at, host = authority.rpartition("@")
    if at:
        if any(b not in USER_LEGAL for b in user.encode("utf-8", "surrogatepass")):
            return None
        parts = [_decoded(x) for x in user.split(":", 1)]
        if None in parts:
            return None
        user = ":".join(_escaped(x, USER_KEPT) for x in parts)
    if host.startswith("["):
        inside, closed, tail = host.rpartition("]")
        if not closed or not re.fullmatch(r"(?::[0-9]*)?", tail):
            return None
        address, percent, zone = inside.partition("%25")
        if ":" not in address or "%" in address or parse_ip(address[1:]) is None:
            return None
        host = address + ("%" + zone if percent else "") + closed + tail
    else:
        if ":" in host and not re.fullmatch(r"[0-9]*", host.rpartition(":")[2]):
            return None
        plain = _decoded(host, strict_host=True)
        if plain is None or any(b < 128 and b not in HOST_LEGAL for b in host.replace("%", "").encode("utf-8", "surrogatepass")):
            return None
        host = plain.decode("utf-8", "replace")
    plain = _decoded(path)
    if plain is None:
        return None
    if any(b not in PATH_LEGAL for b in path.encode("utf-8", "surrogatepass")):
        path = _escaped(plain, PATH_KEPT)
    return scheme.lower(), user if at else None, host, path, query


def clean_path(path: str) -> str:
    """Dot segments and doubled slashes resolved; a slash at the end stays."""
    kept: list[str] = []
    for segment in path.split("/"):
        if segment == "..":
            del kept[-1:]
        elif segment not in ("", "."):
            kept.append(segment)
    return "/" + "/".join(kept) + ("/" if kept and path.endswith("/") else "")


def domain_form(v: str) -> str | None:
    if HAS_SCHEME.match(v):
        parts = parse_url(v)
        if parts and parts[2]:
            v = parts[2]
    v = re.split(r"[/?#]", v, maxsplit=1)[0].rpartition("@")[2].removesuffix(".")
    split = split_port(v)
    v = split[0] if split else v
    host = host_form(v) if v else None
    return host if host and parse_ip(host) is None and is_domain(host) else None


def url_form(v: str) -> str | None:
    parts = parse_url(v if HAS_SCHEME.match(v) else "http://" + v)
    if parts is None or not parts[2]:
        return None
    scheme, user, authority, path, query = parts
    split = split_port(authority)
    host = host_form(split[0]) if split else None
    if host is None:
        return None
    port = split[1]
    return "".join((
        scheme, "://", "" if user is None else user + "@", f"[{host}]" if ":" in host else host,
        f":{port}" if port and DEFAULT_PORT.get(scheme) != port else "", clean_path(path), f"?{query}" if query else "",
    ))


def email_form(v: str) -> str | None:
    local, _, domain = v.rpartition("@")
    if not local or not domain:
        return None
    host = host_form(domain.removesuffix("."))
    return f"{local.lower()}@{host}" if host and is_domain(host) else None


def hash_form(kind: str, v: str) -> str | None:
    prefix, colon, rest = v.partition(":")
    if colon and prefix.lower() == kind:
        v = rest
    return v.lower() if HEX.match(v) and len(v) == HEX_LENGTH[kind] else None


def infer_type(v: str) -> str | None:
    """The type of a value that is no longer disarmed."""
    if HEX.match(v):
        for kind, n in HEX_LENGTH.items():
            if len(v) == n:
                return kind
    if HAS_SCHEME.match(v):
        return "url"
    ip = parse_ip(v)
    if ip is not None:
        return f"ipv{ip.version}"
    if parse_network(v):
        return "cidr"
    if "@" in v:
        return "email"
    if "/" in v:
        return "url"
    return "domain" if "." in v and not any(c in v for c in " \t?#:") and domain_form(v) else None


def observable(kind: str | None, raw: str | None) -> tuple[str, str] | None:
    """(type, value) in canonical form. None, '' and 'auto' have the type inferred; a declared type is never changed."""
    v = defang(raw)
    if not v:
        return None
    if kind in (None, "", "auto"):
        kind = infer_type(v)
    if kind in ("ipv4", "ipv6"):
        ip = parse_ip(v)
        value = str(ip) if ip is not None and kind == f"ipv{ip.version}" else None
    elif kind == "cidr":
        value = parse_network(v)
    elif kind == "domain":
        value = domain_form(v)
    elif kind == "url":
        value = url_form(v)
    elif kind == "email":
        value = email_form(v)
    elif kind in HEX_LENGTH:
        value = hash_form(kind, v)
    else:
        return None
    return (kind, value) if value is not None else None


def cve_id(raw: str | None) -> str | None:
    m = CVE.match((raw or "").strip(BLANKS).upper())
    return f"CVE-{m[1]}-{m[2].lstrip('0').rjust(4, '0')}" if m else None


# Letters with marks, by the plain letter that replaces them in slugs.
PLAIN_LETTERS = {"a": "áàâäãå", "e": "éèêë", "i": "íìîï", "o": "óòôöõø", "u": "úùûü", "n": "ñ", "c": "ç", "y": "ýÿ", "s": "ß"}
_PLAIN = {ord(x): plain for plain, marked in PLAIN_LETTERS.items() for x in marked}


def slugify(text: str | None) -> str:
    """Lower-case ASCII letters and digits joined by hyphens, at most 200 characters."""
    text = "".join(c for c in (text or "").strip(BLANKS).lower().translate(_PLAIN) if c.isascii())
    return re.sub(r"[^a-z0-9]+", "-", text).strip("-")[:200].strip("-")


def breach_slug(slug: str | None, name: str | None, breach_year: int | None, disclosed_year: int | None) -> str | None:
    given = slugify(slug)
    if given:
        return given
    base = slugify(name)
    year = breach_year if breach_year is not None else disclosed_year
    return None if not base else base if year is None else f"{base}-{year}"
