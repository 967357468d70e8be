"""Secret scan by assignment-aware lexing.

A text is lexed as source or configuration: names, quoted literals, assignment
signs and plus signs. A name (or quoted key) before an assignment sign and the
terms after it form a name-literal pair; names of earlier literals stand for
them (constants propagate, also through concatenation) until something unknown is
assigned to the name. A type between name and sign is passed over. A subscript by a
quoted name is a target like that name, and so are a setter's name before its one
argument and the first of two quoted arguments of a setter. Strings may have prefixes
or three quotes (then without the white space at their ends); a formatted one with
fields is no literal. A literal is scored by its target's name and by its own look,
so that ``x = "..."; password = x`` is found at the literal; where some terms are
unknown (calls, other names), the literal ones are scored one by one. Three fixed
patterns always count beside that.

Where a line is no more than name, sign and a bare value (.env, YAML, INI,
properties), the value up to the line's end is a literal, without a comment after
it and without a comma or semicolon at its end. Calls, lists, variables, types, paths
of names without a digit and names of constants are no values. Block scalars of YAML
(their lines, scored by the best one) and the text of an element named by its tag are
literals too.

Spans: kind, start, end (code points, end exclusive), score, name. Kinds in this
order: ``assign``, ``access``, ``hex`` (the fixed patterns: their whole match),
``literal`` (found by lexing; only where no ``assign`` span holds it).

Defined results: null text counts as empty; an empty text has no span. Repeated
rows are scanned alike. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6

#: Parts of names that make a target sensitive, and how much.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.8, "secret": 1.0, "token": 0.9, "apikey": 0.9, "accesskey": 0.9,
    "privatekey": 1.0, "credential": 0.9, "authkey": 0.8, "encryptionkey": 0.9, "signingkey": 0.9, "clientkey": 0.7,
}
#: All bytes but those that ``name_score`` looks at.
_SEPARATORS = bytes(b for b in range(256) if not (48 <= b <= 57 or 97 <= b <= 122))
PLACEHOLDER = re.compile(r"^(x+|\*+|\.+|changeme|example|password|passwd|secret|token|none|null|true|false|undefined|todo|your.*|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s)$", re.IGNORECASE)
LEAST_SCORE = 0.5

TOKEN = re.compile(
    r"""(?P<string>\"{3}[\s\S]*?\"{3}|'{3}[\s\S]*?'{3}|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
    r"""|(?P<name>[A-Za-z_$][\w$.-]*)"""
    r"""|(?P<assign>:=|=>|==+|!=|<=|>=|=|:)"""
    r"""|(?P<plus>\+)|(?P<end>[\n;,{}()\[\]])|(?P<other>[^\s"'`A-Za-z_$:=!<>+\n;,{}()\[\]]+|.)"""
)
ASSIGNING = frozenset((":=", "=>", "=", ":"))
DECLARING = frozenset(("var", "const", "let"))
CLOSING = {"(": ")", "[": "]", "{": "}"}
#: Names of types, which stand beside a declared name, and words of a type before another.
TYPES = frozenset("str string bytes bytearray byte char rune any object final optional text varchar boolean bool int integer number float double unknown never null undefined secretstr".split())
TYPE_WORDS = frozenset("static mut const dyn unsigned readonly keyof typeof".split())

#: A line of configuration. A value begins with no quote; a comment follows white space.
BARE = re.compile(
    r"""^[^\S\n]*(?:-[^\S\n]+)?(?:(?:export|set|setx|env|arg|declare|local)[^\S\n]+)?(?P<quote>["']?)(?P<name>[A-Za-z_$][\w$.-]*)(?P=quote)"""
    r"""[^\S\n]*(?:=>|:=|=(?!=)|:)[^\S\n]*(?P<value>(?![fFrRbBuU]{1,2}["'])[^\s"'`#]\S*+)(?:[^\S\n]+(?:\#|;|//)[^\n]*)?[^\S\n]*$""",
    re.MULTILINE | re.IGNORECASE,
)
#: A block scalar: the lines after the sign that are further to the right.
SCALAR = re.compile(
    r"""^(?P<indent>[^\S\n]*+)(?:-[^\S\n]+)?(?P<quote>["']?)(?P<name>[A-Za-z_$][\w$.-]*)(?P=quote)[^\S\n]*:[^\S\n]*[|>][-+0-9]*[^\S\n]*\n"""
    r"""(?P<body>(?:(?P=indent)[^\S\n]++\S[^\n]*(?:\n|\Z)|[^\S\n]*+\n)+)""",
    re.MULTILINE,
)
#: An element of one word.
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.:-]*+)(?:\s[^<>]*+)?>\s*+(?P<value>[^<>\s]++)\s*+</(?P=name)\s*+>")
#: What stands before a string's quotes; names of functions that set a value.
PREFIX = re.compile(r"[rRbBuU]{1,2}|[fF][rR]?|[rR][fF]")
SETTER = re.compile(r"(?:[\w$.-]*[.-])?(?:(?:[sS]et|[pP]ut|[aA]dd|[dD]efine)(?![a-z])[\w$]*|[sS]etenv|putenv|setdefault)")
#: A call, a list or map, a variable, a path of names without a digit: no value itself.
CODE = re.compile(r"[A-Za-z_$][\w$.]*\(.*\)|\[.*\]|\{.*\}|\$[A-Za-z_]\w*|%\w+%|[A-Za-z_$][^\W\d]*(?:(?:\.|::|->)[A-Za-z_$][^\W\d]*)+")


def name_score(name: str) -> float:
    """The score of the most sensitive part of a target's name."""
    flat = re.sub(r"[^a-z0-9]", "", name.lower())
    return max((s for part, s in SENSITIVE.items() if part in flat), default=0.0)


def may_hold_names(text: str) -> bool:
    """False only if no name in the text can score: what names lose before they
    are looked at, separators, the whole text loses here."""
    flat = text.lower().encode("ascii", "ignore").translate(None, _SEPARATORS)
    return any(part.encode() in flat for part in SENSITIVE)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret: length, kinds of characters, entropy."""
    if len(value) < LEAST_ASSIGNED or PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, 0.3 + 0.12 * kinds + 0.1 * entropy)


def _tokens(text: str) -> list[tuple[str, str, int, int]]:
    out: list[tuple[str, str, int, int]] = []
    for m in TOKEN.finditer(text):
        kind, piece, start = m.lastgroup, m.group(), m.start()
        if kind == "other" and piece.isspace():
            continue
        if kind == "string" and out and out[-1][0] == "name" and out[-1][3] == start and PREFIX.fullmatch(out[-1][1]):
            if "f" in out.pop()[1].lower() and "{" in piece:
                kind = "other"
        out.append((kind, piece, start, m.end()))
    return out


def _content(text: str, start: int, end: int) -> tuple[int, int]:
    """Where the content of the quoted string at start to end lies."""
    quotes = 3 if end - start >= 6 and text[start : start + 3] in ('"""', "'''") else 1
    start, end = start + quotes, end - quotes
    if quotes == 3:
        piece = text[start:end]
        end -= len(piece) - len(piece.rstrip())
        start = min(end, start + len(piece) - len(piece.lstrip()))
    return start, end


def _given(tokens: list[tuple[str, str, int, int]], i: int) -> tuple[str, int] | None:
    """The target that a setter, whose name is token i, gives its last argument to, and
    the place of that: ``set_pwd(value)``, ``setProperty("db.pwd", value)``."""
    name = tokens[i][1]
    if i + 3 >= len(tokens) or tokens[i + 1][1] != "(" or not SETTER.fullmatch(name):
        return None
    if tokens[i + 3][1] == ")":
        return name, i + 2
    if i + 5 < len(tokens) and tokens[i + 2][0] == "string" and tokens[i + 3][1] == "," and tokens[i + 5][1] == ")":
        return tokens[i + 2][1].strip("\"'`"), i + 4
    return None


def _matches(tokens: list[tuple[str, str, int, int]]) -> dict[int, int]:
    """The place of the closing bracket of every opening one that has it."""
    found: dict[int, int] = {}
    open_ones: list[int] = []
    for i, (kind, piece, *_) in enumerate(tokens):
        if kind == "end":
            if piece in CLOSING:
                open_ones.append(i)
            elif open_ones and piece == CLOSING[tokens[open_ones[-1]][1]]:
                found[open_ones.pop()] = i
            elif piece in ")]}":
                open_ones.clear()
    return found


def _after_type(tokens: list[tuple[str, str, int, int]], closing: dict[int, int], i: int) -> int:
    """The place of the = after a type that begins at i, or -1 if there is none."""
    named = False
    while i < len(tokens):
        kind, piece, *_ = tokens[i]
        if kind == "assign":
            return i if piece == "=" and named else -1
        if kind == "name":
            if named and tokens[i - 1][0] == "name" and tokens[i - 1][1].lower() not in TYPE_WORDS:
                return -1
            named = True
        elif i in closing and piece in "[(":
            i = closing[i]
        elif kind != "other" or piece.strip("&|?*.'<>"):
            return -1
        i += 1
    return -1


def _targets(tokens: list[tuple[str, str, int, int]], closing: dict[int, int], i: int) -> tuple[list[str], int] | None:
    """The names that the name or key i may assign to, and the place of the sign."""
    kind, name, *_ = tokens[i]
    sign = i + 1
    if kind == "name" and sign + 1 < len(tokens) and tokens[sign][1] in ("?", "!") and tokens[sign + 1][1] == ":":
        sign += 1
    if kind == "string" and i and tokens[i - 1][1] == "[" and sign + 1 < len(tokens) and tokens[sign][1] == "]" and tokens[sign + 1][1] == "=":
        sign += 1
    if sign >= len(tokens) or tokens[sign][0] != "assign" or tokens[sign][1] not in ASSIGNING:
        return None
    if kind == "name" and tokens[sign][1] == ":":
        return [name], max(sign, _after_type(tokens, closing, sign + 1))
    names = [name.strip("\"'`")]
    # The name before may be the declared one, this one its type: var pwd string = "...".
    if kind == "name" and i and tokens[i - 1][0] == "name" and tokens[i - 1][1] not in DECLARING and (name.lower() in TYPES or (i > 1 and tokens[i - 2][1] in DECLARING)):
        names.append(tokens[i - 1][1])
    return names, sign


def assigned_literals(text: str) -> list[tuple[int, int, float, str]]:
    """(start, end, score, target name) of literals that reach a sensitive name."""
    tokens = _tokens(text)
    closing = _matches(tokens)
    constants: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
    found: dict[tuple[int, int], tuple[float, str]] = {}

    def report(span: tuple[int, int], score: float, target: str) -> None:
        if score >= LEAST_SCORE and span[1] > span[0] and score > found.get(span, (0.0, ""))[0]:
            found[span] = (score, target)

    # Up to here the arguments of some call go: a keyword there assigns nothing.
    called = 0
    i = 0
    while i + 2 < len(tokens):
        if tokens[i][1] == "(" and i in closing:
            called = max(called, closing[i])
        given = _given(tokens, i) if tokens[i][0] == "name" else None
        if given is not None and name_score(given[0]):
            kind, piece, start, end = tokens[given[1]]
            if kind == "string":
                span = _content(text, start, end)
                report(span, name_score(given[0]) * literal_score(text[span[0] : span[1]]), given[0])
            elif kind == "name" and piece in constants:
                for span in constants[piece][1]:
                    report(span, name_score(given[0]) * literal_score(constants[piece][0]), given[0])
        assigned = _targets(tokens, closing, i) if tokens[i][0] in ("name", "string") else None
        if assigned is None:
            i += 1
            continue
        targets, sign = assigned
        target = max(targets, key=name_score)
        j, value, spans, whole = sign + 1, "", [], True
        while j < len(tokens):
            kind, piece, start, end = tokens[j]
            rest = j + 1
            if kind == "string":
                spans.append(_content(text, start, end))
                value += text[spans[-1][0] : spans[-1][1]]
            elif kind == "name" and piece in constants:
                value += constants[piece][0]
                spans.extend(constants[piece][1])
            else:
                whole, rest = False, j
            # A call's arguments, a subscript and the like belong to the term.
            after = rest
            while after < len(tokens) and tokens[after][0] not in ("plus", "assign") and (after in closing or tokens[after][0] != "end"):
                after = closing.get(after, after) + 1
            if after >= len(tokens) or tokens[after][0] != "plus" or after == j:
                break
            whole = whole and after == rest
            j = after + 1
            while j < len(tokens) and tokens[j][1] == "\n":
                j += 1
        sensitive = name_score(target)
        for span in spans:
            report(span, sensitive * literal_score(value if whole else text[span[0] : span[1]]), target)
        if whole and spans:
            constants.update((name, (value, tuple(spans))) for name in targets)
            i = j + 1
        else:
            if tokens[sign][1] in ("=", ":=") and i >= called:
                for name in targets:
                    constants.pop(name, None)
            i = sign + 1
    for m in SCALAR.finditer(text):
        if name_score(m["name"]) and m["body"].strip():
            start = m.end("body") - len(m["body"].lstrip())
            best = max(literal_score(line.strip()) for line in m["body"].split("\n"))
            report((start, start + len(m["body"].strip())), name_score(m["name"]) * best, m["name"])
    for m in ELEMENT.finditer(text):
        report((m.start("value"), m.end("value")), name_score(m["name"]) * literal_score(m["value"]), m["name"])
    for m in BARE.finditer(text):
        value = m["value"].rstrip(",;")
        if name_score(m["name"]) and value not in constants and value.lower() not in TYPES and not CODE.fullmatch(value):
            report((m.start("value"), m.start("value") + len(value)), name_score(m["name"]) * literal_score(value), m["name"])
    return [(s, e, score, name) for (s, e), (score, name) in found.items()]


def scan(text: str | None) -> list[dict]:
    """All spans of a text, by start, then kind as listed, then end."""
    if not text:
        return []
    spans: list[tuple[int, int, int, float, str]] = []
    if may_hold_names(text):
        held = [(m.start(), m.end(), m.group(1)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGNED]
        spans += [(s, 0, e, name_score(name) * max(LEAST_SCORE, literal_score(text[s:e])), name) for s, e, name in held]
        at = 0
        for s, e, score, name in sorted(assigned_literals(text)):
            while at < len(held) and held[at][1] < e:
                at += 1
            if not (at < len(held) and held[at][0] <= s):
                spans.append((s, 3, e, score, name))
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), 0.95, "") for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end(), 0.6, "") for m in HEX.finditer(text)]
    return [{"kind": KINDS[k], "start": s, "end": e, "score": score, "name": name} for s, k, e, score, name in sorted(spans)]


def find_secrets(documents: DataFrame) -> DataFrame:
    """doc_id, spans (array of kind, start, end, score, name) of every text."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("name", pa.string())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([scan(t) for t in batch.column("text").to_pylist()], kind)], names=["doc_id", "spans"])

    return map_batches(documents.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double,name:string>>")
