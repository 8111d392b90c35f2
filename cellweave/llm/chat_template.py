"""Chat formatting: a template compiler for a small sandboxed language, and conversations as documents.

Templates know ``{{ expression }}``, ``{% for x in list %}``, ``{% if %}``/``elif``/``else``,
``{% set name = expression %}``, ``{% generation %}`` ... ``{% endgeneration %}`` and
``{# comments #}``. A ``-`` inside a marker strips the white space next to it. Expressions
have literals, names, ``a.b`` and ``a["b"]`` on mappings and sequences, ``+ ~ ==
!= < <= > >= in not and or``, ``x if c else y`` and the filters of ``FILTERS``. There are no
calls and no attributes of Python objects, so a template reaches only what it is given.

Parsing gives a syntax tree of tuples; ``fold`` computes what is constant and joins
neighbouring texts; ``compile_template`` turns the tree into Python closures.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.session import ship


class TemplateError(ValueError):
    pass


_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape_control(text: str) -> str:
    """Break every ``<|`` so that no text can hold a control string; ``unescape_control`` undoes it."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    """``escape_control`` that also keeps to one line."""
    return escape_control(text).replace("\n", "\\n")


def unescape_control(text: str) -> str:
    return _UNESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


def _str(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


FILTERS: dict[str, Callable] = {
    "trim": lambda v: _str(v).strip(),
    "upper": lambda v: _str(v).upper(),
    "lower": lambda v: _str(v).lower(),
    "length": len,
    "string": _str,
    "escape_control": lambda v: escape_control(_str(v)),
    "escape_line": lambda v: escape_line(_str(v)),
}
_BINARY: dict[str, Callable] = {
    "+": lambda a, b: a + b,
    "~": lambda a, b: _str(a) + _str(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
}
_MARK = re.compile(r"\{#.*?#\}|\{\{-?.*?-?\}\}|\{%-?.*?-?%\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(\d+)|("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>|.\[\]()=]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over the tokens of one marker."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, object]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            if m[1]:
                self.tokens.append(("value", int(m[1])))
            elif m[2]:
                self.tokens.append(("value", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), m[2][1:-1], flags=re.DOTALL)))
            else:
                self.tokens.append(("name" if m[3] else "sign", m[3] or m[4]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def take(self, *wanted: str) -> str | None:
        kind, what = self.peek()
        if kind in ("name", "sign") and what in wanted:
            self.at += 1
            return what
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"expected {wanted!r}, found {self.peek()[1]!r}")

    def name(self) -> str:
        kind, what = self.peek()
        if kind != "name":
            raise TemplateError(f"expected a name, found {what!r}")
        self.at += 1
        return what

    def done(self, tree):
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return tree

    def choice(self):
        tree = self.either()
        if self.take("if"):
            test = self.either()
            other = self.choice() if self.take("else") else ("value", "")
            return ("choice", test, tree, other)
        return tree

    def either(self):
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self):
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        tree = self.joined()
        while True:
            sign = self.take("==", "!=", "<=", ">=", "<", ">", "in")
            if sign:
                tree = ("binary", sign, tree, self.joined())
            elif self.peek() == ("name", "not") and self.tokens[self.at + 1 : self.at + 2] == [("name", "in")]:
                self.at += 2
                tree = ("not", ("binary", "in", tree, self.joined()))
            else:
                return tree

    def joined(self):
        tree = self.piped()
        while sign := self.take("+", "~"):
            tree = ("binary", sign, tree, self.piped())
        return tree

    def piped(self):
        tree = self.place()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def place(self):
        kind, what = self.peek()
        if self.take("("):
            tree = self.choice()
            self.need(")")
        elif self.take("-"):
            return ("negative", self.place())
        elif kind == "value":
            self.at += 1
            tree = ("value", what)
        else:
            word = self.name()
            tree = ("value", {"true": True, "false": False, "none": None}[word.lower()]) if word.lower() in ("true", "false", "none") else ("name", word)
        while True:
            if self.take("."):
                tree = ("item", tree, ("value", self.name()))
            elif self.take("["):
                tree = ("item", tree, self.choice())
                self.need("]")
            else:
                return tree


def parse(source: str) -> tuple:
    """The syntax tree: ``("block", [nodes])``."""
    parts: list[tuple[str, str]] = []
    at, strip = 0, False
    for m in _MARK.finditer(source):
        mark = m[0]
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        comment = mark.startswith("{#")
        text = text.rstrip() if not comment and mark[2] == "-" else text
        parts.append(("text", text))
        if not comment:
            strip = mark[-3] == "-"
            parts.append((mark[1], mark[2:-2].removeprefix("-").removesuffix("-").strip()))
        else:
            strip = False
        at = m.end()
    parts.append(("text", source[at:].lstrip() if strip else source[at:]))
    items = iter(parts)
    tree, end = _block(items, ())
    return tree


def _block(items: Iterator, ends: tuple[str, ...]) -> tuple[tuple, str]:
    nodes: list[tuple] = []
    for kind, body in items:
        if kind == "text":
            if "{{" in body or "{%" in body:
                raise TemplateError(f"a marker is not closed: {body[:40]!r}")
            nodes.append(("text", body))
        elif kind == "{":
            e = _Expression(body)
            nodes.append(("print", e.done(e.choice())))
        else:
            word, _, rest = body.partition(" ")
            if word in ends:
                return ("block", nodes), body
            if word == "for":
                e = _Expression(rest)
                name = e.name()
                e.need("in")
                over = e.done(e.choice())
                inner, _ = _block(items, ("endfor",))
                nodes.append(("for", name, over, inner))
            elif word == "if":
                nodes.append(_if(items, rest))
            elif word == "set":
                e = _Expression(rest)
                name = e.name()
                e.need("=")
                nodes.append(("set", name, e.done(e.choice())))
            elif word == "generation":
                inner, _ = _block(items, ("endgeneration",))
                nodes.append(("generation", inner))
            else:
                raise TemplateError(f"no statement {word!r}")
    if ends:
        raise TemplateError(f"{ends[0]} is missing")
    return ("block", nodes), ""


def _if(items: Iterator, test: str) -> tuple:
    e = _Expression(test)
    condition = e.done(e.choice())
    then, end = _block(items, ("elif", "else", "endif"))
    other: tuple = ("block", [])
    if end.startswith("elif"):
        other = ("block", [_if(items, end[4:])])
    elif end.startswith("else"):
        other, _ = _block(items, ("endif",))
    return ("if", condition, then, other)


def fold(node: tuple) -> tuple:
    """The tree with constant expressions computed, dead branches gone and neighbouring texts joined."""
    kind = node[0]
    if kind == "block":
        out: list[tuple] = []
        for child in map(fold, node[1]):
            for x in child[1] if child[0] == "block" else [child]:
                if x[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + x[1])
                elif x != ("text", ""):
                    out.append(x)
        return ("block", out)
    if kind in ("text", "value", "name"):
        return node
    parts = tuple(fold(x) if isinstance(x, tuple) else x for x in node)
    if kind == "print":
        return ("text", _str(parts[1][1])) if parts[1][0] == "value" else parts
    if kind in ("if", "choice"):
        return (parts[2] if parts[1][1] else parts[3]) if parts[1][0] == "value" else parts
    if kind in ("or", "and") and parts[1][0] == "value":
        return parts[2] if bool(parts[1][1]) == (kind == "and") else parts[1]
    if kind in ("not", "negative", "binary", "filter", "item") and all(x[0] == "value" for x in parts[1:] if isinstance(x, tuple)):
        try:
            return ("value", _evaluator(parts)({}))
        except Exception as e:
            raise TemplateError(f"a constant can't be computed: {e}") from e
    return parts


def _evaluator(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "value":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "item":
        of, key = _evaluator(node[1]), _evaluator(node[2])

        def item(env):
            a, b = of(env), key(env)
            if isinstance(a, Mapping):
                return a.get(b)
            return a[b] if isinstance(a, (list, tuple, str)) and isinstance(b, int) and -len(a) <= b < len(a) else None

        return item
    if kind == "filter":
        function, of = FILTERS[node[1]], _evaluator(node[2])
        return lambda env: function(of(env))
    if kind == "binary":
        function, a, b = _BINARY[node[1]], _evaluator(node[2]), _evaluator(node[3])
        return lambda env: function(a(env), b(env))
    parts = [_evaluator(x) for x in node[1:]]
    if kind == "not":
        return lambda env: not parts[0](env)
    if kind == "negative":
        return lambda env: -parts[0](env)
    if kind == "and":
        return lambda env: parts[0](env) and parts[1](env)
    if kind == "or":
        return lambda env: parts[0](env) or parts[1](env)
    return lambda env: parts[1](env) if parts[0](env) else parts[2](env)  # choice


class _Output:
    def __init__(self) -> None:
        self.texts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.texts.append(text)
        self.length += len(text)


def _writer(node: tuple) -> Callable[[dict, _Output], None]:
    kind = node[0]
    if kind == "block":
        writers = [_writer(x) for x in node[1]]
        if len(writers) == 1:
            return writers[0]

        def block(env, out):
            for w in writers:
                w(env, out)

        return block
    if kind == "text":
        text = node[1]
        return lambda env, out: out.add(text)
    if kind == "print":
        value = _evaluator(node[1])
        return lambda env, out: out.add(_str(value(env)))
    if kind == "set":
        name, value = node[1], _evaluator(node[2])
        return lambda env, out: env.__setitem__(name, value(env))
    if kind == "if":
        test, then, other = _evaluator(node[1]), _writer(node[2]), _writer(node[3])
        return lambda env, out: (then if test(env) else other)(env, out)
    if kind == "generation":
        inner = _writer(node[1])

        def generation(env, out):
            start = out.length
            inner(env, out)
            out.spans.append((start, out.length))

        return generation
    name, over, inner = node[1], _evaluator(node[2]), _writer(node[3])

    def loop(env, out):
        items = list(over(env) or ())
        hidden = env.get(name), env.get("loop")
        for i, item in enumerate(items):
            env[name] = item
            env["loop"] = {"index0": i, "index": i + 1, "first": i == 0, "last": i == len(items) - 1, "length": len(items)}
            inner(env, out)
        env[name], env["loop"] = hidden

    return loop


@lru_cache(maxsize=64)
def compile_template(source: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from the names that a template uses to its output and the spans of its generations."""
    write = _writer(fold(parse(source)))

    def render(names: dict) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        write(dict(names), out)
        return "".join(out.texts), out.spans

    return render


TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
#: Marks turns, escapes what texts and roles hold, and puts assistant texts under the loss.
DEFAULT_TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' ~ (m.role | escape_line) ~ '\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape_control }}{% endgeneration %}"
    "{% else %}{{ m.text | escape_control }}{% endif %}{{ '<|im_end|>' }}\n{% endfor %}"
)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of an output of ``DEFAULT_TEMPLATE``."""
    turns = []
    for part in formatted.split(TURN_START)[1:]:
        role, _, text = part.partition("\n")
        turns.append((unescape_control(role), unescape_control(text.removesuffix(TURN_END))))
    return turns


def format_conversations(turns: DataFrame, template: str = DEFAULT_TEMPLATE, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: the key, ``n_turns``, ``formatted`` and ``loss_spans``.

    Turns come in the order of ``turn`` (nulls first), then role and text, so ties and
    repeated rows have one order and all stay. Null roles and texts are empty strings; a row
    with a null key can't be told to belong to another, so it is a conversation of its own, with
    a null key; an empty table gives no rows; other columns are ignored. ``loss_spans`` are [start, end) code points of generations.

    Turns are dealt out by key and sorted by Spark, which spills; a task then renders its
    conversations one after the other, so it holds one conversation, which is one output row.
    """
    compile_template(template)
    ship(turns.sparkSession)
    narrow = turns.select(
        F.col(f"`{key}`").alias("k"), F.col(f"`{turn}`").alias("n"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("r"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")
    )
    kind = dict(narrow.dtypes)["k"]
    alone = F.when(F.col("k").isNull(), F.xxhash64("n", "r", "t"))
    ordered = narrow.repartition("k", alone).sortWithinPartitions("k", "n", "r", "t")
    schema = f"k {kind}, n_turns long, formatted string, loss_spans array<struct<start:long,end:long>>"
    from cellweave.llm.common import _arrow_schema

    types = _arrow_schema(turns, schema)

    def run(batches):
        render = compile_template(template)

        def finish(k, messages):
            out, spans = render({"messages": messages})
            return k, len(messages), out, [{"start": a, "end": b} for a, b in spans]

        def send(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)], schema=types)

        now, messages, rows, held = None, [], [], 0
        for batch in batches:
            for k, r, t in zip(*(batch.column(c).to_pylist() for c in ("k", "r", "t")), strict=True):
                if messages and (k != now or k is None):
                    rows.append(finish(now, messages))
                    held += len(rows[-1][2])
                    messages = []
                    if held > 8_000_000 or len(rows) >= 2_000:
                        yield send(rows)
                        rows, held = [], 0
                now = k
                messages.append({"role": r, "text": t})
        if messages:
            rows.append(finish(now, messages))
        if rows:
            yield send(rows)

    return ordered.mapInArrow(run, schema).withColumnRenamed("k", key)


def digest(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """Read every output back: hashes of its turns and of the text under its loss mask."""
    from cellweave.llm.common import map_batches

    narrow = formatted.select(F.col(f"`{key}`").alias("k"), "formatted", "loss_spans")
    kind = dict(narrow.dtypes)["k"]

    def run(batch):
        out = {n: [] for n in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for whole, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True):
            turns = read_back(whole)
            loss = "".join(unescape_control(whole[s["start"] : s["end"]]) for s in spans)
            out["n_turns"].append(len(turns))
            out["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
            out["loss_chars"].append(len(loss))
            out["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
            out["formatted_chars"].append(len(whole))
        return out | {"k": batch.column("k")}

    schema = f"k {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_batches(narrow, run, schema).withColumnRenamed("k", key)
