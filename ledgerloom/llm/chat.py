"""Chat formatting: templates compiled to Python closures.

A template is text with ``{{ expression }}`` and ``{% statement %}``. Statements:
``for x in list`` / ``endfor``, ``if`` / ``elif`` / ``else`` / ``endif``, ``set x =
expression`` and ``generation`` / ``endgeneration``, which marks the text under
the loss. Expressions: names, string and integer constants, ``x.field``,
``x["field"]``, ``+``, comparisons, ``in``, ``and`` / ``or`` / ``not`` and
``| filter``. That is all: no calls, no attributes of Python objects, only the
variables given and the filters listed. A ``{%-`` or ``-%}`` trims white space.

``compiled`` parses the template, folds what is constant and returns a closure.
``format_conversations`` runs it over a table. A conversation is rendered turn by
turn from sorted rows, so that a task holds one turn (and the next), never a
whole conversation; its output comes in parts that end between turns. A template
can go over ``messages`` once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

PART_CHARS = 1 << 18
BREAK = ("", None)

CHATML = (
    "{% for message in messages %}"
    "<|im_start|>{{ message.role | escape_line }}\n"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "<|im_end|>\n{% endfor %}"
)


def escape(text: str) -> str:
    """Break every ``<|`` by a backslash; ``unescape`` is the inverse."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_line(text: str) -> str:
    """``escape`` for a text that must stay on one line."""
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


FILTERS: dict[str, Callable] = {
    "escape": escape,
    "escape_line": escape_line,
    "trim": lambda x: x.strip(),
    "upper": lambda x: x.upper(),
    "lower": lambda x: x.lower(),
    "length": len,
}

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(\d+)|("(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+<>|.()\[\]=]))""")
_ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    """The template is not one of the language above."""


def _tokens(source: str) -> list[tuple[str, object]]:
    out, at, source = [], 0, source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        number, quoted, name, sign = m.groups()
        if number is not None:
            out.append(("const", int(number)))
        elif quoted is not None:
            out.append(("const", re.sub(r"\\(.)", lambda x: _ESCAPES.get(x[1], x[1]), quoted[1:-1], flags=re.S)))
        elif name is not None:
            out.append(("const", name == "true") if name in ("true", "false") else ("name", name))
        else:
            out.append(("sign", sign))
        at = m.end()
    return out


class _Expression:
    """Parses one expression into nested tuples, constants folded."""

    LEVELS = (("or",), ("and",), ("==", "!=", "<", ">", "<=", ">=", "in"), ("+",))
    APPLY = {
        "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
        "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "+": lambda a, b: a + b,
        "and": lambda a, b: a and b, "or": lambda a, b: a or b, "not": lambda a: not a,
    }

    def __init__(self, source: str):
        self.left = _tokens(source)
        self.tree = self.binary(0)
        if self.left:
            raise TemplateError(f"unexpected {self.left[0][1]!r} in {source!r}")

    def peek(self):
        return self.left[0][1] if self.left and self.left[0][0] != "const" else None

    def take(self, kind: str):
        if not self.left or self.left[0][0] != kind:
            raise TemplateError(f"expected a {kind}")
        return self.left.pop(0)[1]

    def expect(self, sign: str):
        if self.take("sign") != sign:
            raise TemplateError(f"expected {sign!r}")

    def node(self, op: str, *parts):
        if all(p[0] == "const" for p in parts):
            return ("const", self.APPLY[op](*[p[1] for p in parts]))
        return ("apply", op, *parts)

    def binary(self, level: int):
        if level == len(self.LEVELS):
            return self.unary()
        out = self.binary(level + 1)
        while self.peek() in self.LEVELS[level]:
            op = self.left.pop(0)[1]
            out = self.node(op, out, self.binary(level + 1))
        return out

    def unary(self):
        if self.peek() == "not":
            self.left.pop(0)
            return self.node("not", self.unary())
        return self.postfix()

    def postfix(self):
        if not self.left:
            raise TemplateError("an expression is missing")
        if self.left[0][0] == "const":
            out = ("const", self.left.pop(0)[1])
        elif self.peek() == "(":
            self.expect("(")
            out = self.binary(0)
            self.expect(")")
        else:
            out = ("name", self.take("name"))
        while self.peek() in (".", "[", "|"):
            sign = self.left.pop(0)[1]
            if sign == ".":
                out = ("field", out, ("const", self.take("name")))
            elif sign == "[":
                out = ("field", out, self.binary(0))
                self.expect("]")
            else:
                name = self.take("name")
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                out = ("const", FILTERS[name](out[1])) if out[0] == "const" else ("filter", name, out)
        return out


def _value(tree) -> Callable[[dict], object]:
    """The closure of an expression."""
    kind = tree[0]
    if kind == "const":
        return lambda env, value=tree[1]: value
    if kind == "name":
        return lambda env, name=tree[1]: env.get(name, "")
    if kind == "filter":
        return lambda env, f=FILTERS[tree[1]], inner=_value(tree[2]): f(inner(env))
    if kind == "field":
        return lambda env, of=_value(tree[1]), key=_value(tree[2]): _field(of(env), key(env))
    op, parts = tree[1], [_value(p) for p in tree[2:]]
    if op == "and":
        return lambda env: parts[0](env) and parts[1](env)
    if op == "or":
        return lambda env: parts[0](env) or parts[1](env)
    apply = _Expression.APPLY[op]
    return lambda env: apply(*[p(env) for p in parts])


def _field(of, key):
    if not isinstance(of, dict):
        raise TemplateError(f"no field {key!r} here")
    return of.get(key, "")


def parsed(template: str) -> list:
    """The syntax tree: a list of text, output, for, if, set and generation nodes.

    Constant outputs become text, neighbouring texts one, and branches whose
    condition is constant are decided.
    """
    pieces, at, trim = [], 0, False
    for m in _TAG.finditer(template):
        text = template[at : m.start()]
        text = text.lstrip() if trim else text
        before, trim = (m[1] or m[4]) == "-", (m[3] or m[6]) == "-"
        pieces.append(("text", text.rstrip() if before else text))
        pieces.append(("output", _Expression(m[2]).tree) if m[2] is not None else ("statement", m[5].strip()))
        at = m.end()
    pieces.append(("text", template[at:].lstrip() if trim else template[at:]))
    out, end = _block(pieces, 0, ())
    return out


def _block(pieces: list, at: int, ends: tuple[str, ...]):
    out: list = []

    def text(value: str):
        if value and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + value)
        elif value:
            out.append(("text", value))

    while at < len(pieces):
        kind, body = pieces[at]
        at += 1
        if kind == "text":
            text(body)
        elif kind == "output":
            if body[0] == "const":
                text(str(body[1]))
            else:
                out.append(("output", body))
        else:
            word, _, rest = body.partition(" ")
            if word in ends:
                return out, (at, word, rest)
            if word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                if not m:
                    raise TemplateError(f"cannot read {body!r}")
                inner, (at, _, _) = _block(pieces, at, ("endfor",))
                out.append(("for", m[1], _Expression(m[2]).tree, inner))
            elif word == "generation":
                inner, (at, _, _) = _block(pieces, at, ("endgeneration",))
                out.append(("generation", inner))
            elif word == "set":
                name, _, value = rest.partition("=")
                if not re.fullmatch(r"[A-Za-z_]\w*", name.strip()):
                    raise TemplateError(f"cannot read {body!r}")
                out.append(("set", name.strip(), _Expression(value).tree))
            elif word == "if":
                arms, end = [], ("elif", rest)
                while end[0] == "elif":
                    condition = _Expression(end[1]).tree
                    inner, (at, *end) = _block(pieces, at, ("elif", "else", "endif"))
                    arms.append((condition, inner))
                if end[0] == "else":
                    inner, (at, _, _) = _block(pieces, at, ("endif",))
                    arms.append((("const", True), inner))
                kept = []
                for condition, inner in arms:
                    if condition[0] != "const":
                        kept.append((condition, inner))
                    elif condition[1]:
                        kept.append((condition, inner))
                        break
                if kept and kept[0][0][0] == "const":
                    for node in kept[0][1]:
                        text(node[1]) if node[0] == "text" else out.append(node)
                elif kept:
                    out.append(("if", kept))
            else:
                raise TemplateError(f"no statement {word!r} here")
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return out, None


def _run(nodes: list, loss: bool) -> Callable[[dict], Iterator[tuple[str, bool | None]]]:
    """The closure of a list of nodes: yields texts, each with its loss mark."""
    steps = []
    for node in nodes:
        kind = node[0]
        if kind == "text":
            steps.append(lambda env, piece=(node[1], loss): (piece,))
        elif kind == "output":
            steps.append(lambda env, value=_value(node[1]): ((str(value(env)), loss),))
        elif kind == "generation":
            steps.append(_run(node[1], True))
        elif kind == "set":
            steps.append(lambda env, name=node[1], value=_value(node[2]): (env.__setitem__(name, value(env)), ())[1])
        elif kind == "if":
            arms = [(_value(c), _run(inner, loss)) for c, inner in node[1]]
            steps.append(lambda env, arms=arms: next((run(env) for test, run in arms if test(env)), ()))
        else:
            steps.append(lambda env, name=node[1], over=_value(node[2]), run=_run(node[3], loss): _loop(env, name, over(env), run))

    def run(env: dict):
        for step in steps:
            yield from step(env)

    return run


def _loop(env: dict, name: str, items: Iterable, run):
    """One item at a time; ``loop.last`` needs one item ahead."""
    if isinstance(items, (str, dict)):
        raise TemplateError("for needs a list")
    outer = {k: env.get(k) for k in (name, "loop") if k in env}
    ahead, end = iter(items), object()
    item, index = next(ahead, end), 0
    while item is not end:
        following = next(ahead, end)
        env[name] = item
        env["loop"] = {"index0": index, "index": index + 1, "first": index == 0, "last": following is end}
        yield from run(env)
        yield BREAK
        item, index = following, index + 1
    for k in (name, "loop"):
        env.pop(k, None)
    env.update(outer)


def compiled(template: str) -> Callable[[dict], Iterator[tuple[str, bool | None]]]:
    """The template as a closure from variables to (text, under loss) pieces.

    The piece ``BREAK`` ends a round of a loop: output can be cut there.
    """
    return _run(parsed(template), False)


def render(template: str, **variables) -> tuple[str, list[tuple[int, int]]]:
    """The whole text and the spans under the loss, for one small conversation."""
    out, spans, at = [], [], 0
    for text, loss in compiled(template)(dict(variables)):
        if loss and text:
            spans.append((at, at + len(text)))
        out.append(text)
        at += len(text)
    return "".join(out), spans


def _conversations(batches, read):
    """Turns of sorted batches as (id, iterator of turns), one conversation after the other."""
    rows = (row for batch in batches for row in read(batch))
    ahead = next(rows, None)
    while ahead is not None:
        key = ahead[0]

        def turns():
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                yield ahead[1]
                ahead = next(rows, None)

        mine = turns()
        yield key, mine
        for _ in mine:  # turns that the template left
            pass


def format_conversations(
    turns: DataFrame,
    template: str = CHATML,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Conversations rendered by a template, in parts.

    Returns rows (``conv_id``, ``part`` from 0, ``text``, ``offset`` of the part in
    the conversation in code points, ``loss``: spans of the part under the loss,
    one per generation). A part ends between turns and holds about 256 thousand
    characters or one turn. Rows stay grouped by conversation and ordered by
    part within a partition, for a reader that follows directly.

    Turns are ordered by turn (null first), then role and text; equal rows all
    count. Null roles and texts are empty; a null id is a conversation of its
    own. Other columns are ignored; an empty table gives none.
    """
    compiled(template)  # a wrong template fails here, not in a task
    kind = turns.schema[conv_col].dataType
    picked = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    ordered = picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("part", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("offset", T.LongType()),
            T.StructField("loss", T.ArrayType(T.ArrayType(T.LongType()))),
        ]
    )

    def read(batch):
        for key, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield key, {"role": role, "text": text}

    def write(batches):
        run, wrap = compiled(template), _Parts()
        for key, messages in _conversations(_watched(batches, wrap), read):
            part, at, out, spans, size = 0, 0, [], [], 0
            inside = False
            for text, loss in run({"messages": messages}):
                if loss:
                    if inside:
                        spans[-1][1] += len(text)
                    else:
                        spans.append([size, size + len(text)])
                elif loss is None and size >= PART_CHARS:
                    yield from wrap.add((key, part, "".join(out), at, spans))
                    part, at, out, spans, size = part + 1, at + size, [], [], 0
                inside = bool(loss)
                out.append(text)
                size += len(text)
            yield from wrap.add((key, part, "".join(out), at, spans))
        yield from wrap.flush()

    return ordered.mapInArrow(write, schema)


def _watched(batches, wrap):
    for batch in batches:
        wrap.key_type = batch.schema.field(0).type
        yield batch


class _Parts:
    """Collects output rows into Arrow batches of bounded size."""

    def __init__(self):
        self.rows, self.size, self.key_type = [], 0, pa.int64()

    def add(self, row):
        self.rows.append(row)
        self.size += len(row[2]) + 100
        if self.size > 1 << 21:
            yield from self.flush()

    def flush(self):
        if self.rows:
            types = [self.key_type, pa.int64(), pa.string(), pa.int64(), pa.list_(pa.list_(pa.int64()))]
            columns = [pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "text", "offset", "loss"])
        self.rows, self.size = [], 0


_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def read_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a part in the markup of ``CHATML``."""
    turns, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape_line(m[1]), unescape(m[2])))
        at = m.end()
    return turns
