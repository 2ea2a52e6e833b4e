"""Chat formatting by a compiled template language (operator 6).

A template is parsed into a syntax tree, constants are folded, and the tree is
compiled to Python closures.  The language is closed: values are strings, numbers,
booleans, ``none`` and the mappings and sequences of the environment; there are no
calls and no attribute access to Python objects, only mapping keys and the filters listed here.

    {{ value }}  {% set x = value %}  {# note #}  ``-`` beside a mark trims white space
    {% for m in messages %} ... {% endfor %}   (loop.index, index0, first, last)
    {% if a %} ... {% elif b %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}    (what is rendered inside is under the loss mask)
    or, and, not, ==, !=, <, <=, >, >=, in, +, ~, |filter, m.key, m['key'], (...)

Rendering is a stream of (text, under mask) segments and ``messages`` may be an iterator, so a
conversation of any length takes bounded memory.

Edge cases: a null role or text is empty; turns are ordered by turn, role, text (nulls first), which
also settles ties and repeated rows; a null conversation id is a group of its own; an empty table
gives no rows; columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

# ---------------------------------------------------------------- template language

MARKS = re.compile(r"(\{%-?.*?-?%\}|\{\{-?.*?-?\}\}|\{#-?.*?-?#\})", re.S)
WORDS = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<num>\d+(?:\.\d+)?)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>+~|.()\[\]=]))""", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    """The template breaks the language's rules."""


def guard(text: str) -> str:
    """Escape every character that a control string begins with; ``unguard`` undoes it."""
    return text.replace("\\", "\\\\").replace("<", "\\<").replace("[", "\\[")


def unguard(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"guard": guard, "trim": str.strip, "upper": str.upper, "lower": str.lower}
BINARY = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
          ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "+": lambda a, b: a + b,
          "~": lambda a, b: shown(a) + shown(b)}
LEVELS = (("==", "!=", "<", "<=", ">", ">=", "in"), ("+", "~"))


def shown(v) -> str:
    return "" if v is None else {True: "true", False: "false"}[v] if isinstance(v, bool) else str(v)


def pick(v, key):
    """A mapping's value, none where it is missing; nothing else has parts."""
    if isinstance(v, dict):
        return v.get(key)
    raise TemplateError(f"no part {key!r} in a {type(v).__name__}")


class Parser:
    """Expressions as tuples: const, name, pick, filter, not, and, or, binary."""

    def __init__(self, text: str):
        self.words, at = [], 0
        while text[at:].strip():
            m = WORDS.match(text, at)
            if not m:
                raise TemplateError(f"can't read {text[at:]!r}")
            self.words.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.words[self.at][1] if self.at < len(self.words) and self.words[self.at][0] in ("op", "name") else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.words[self.at - 1][1]
        return None

    def need(self, kind: str) -> str:
        if self.at == len(self.words) or self.words[self.at][0] != kind:
            raise TemplateError(f"a {kind} is missing")
        self.at += 1
        return self.words[self.at - 1][1]

    def end(self) -> None:
        if self.at < len(self.words):
            raise TemplateError(f"left over: {self.words[self.at][1]!r}")

    def expression(self, level: str = "or"):
        if level in ("or", "and"):
            below = "and" if level == "or" else "not"
            tree = self.expression(below)
            while self.take(level):
                tree = (level, tree, self.expression(below))
            return tree
        return ("not", self.expression("not")) if self.take("not") else self.binary(0)

    def binary(self, k: int):
        if k == len(LEVELS):
            return self.value()
        tree = self.binary(k + 1)
        while op := self.take(*LEVELS[k]):
            tree = ("binary", op, tree, self.binary(k + 1))
        return tree

    def value(self):
        if self.at == len(self.words):
            raise TemplateError("a value is missing")
        kind, word = self.words[self.at]
        self.at += 1
        if kind == "str":
            tree = ("const", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        elif kind == "num":
            tree = ("const", float(word) if "." in word else int(word))
        elif kind == "name":
            consts = {"true": True, "false": False, "none": None}
            tree = ("const", consts[word.lower()]) if word.lower() in consts else ("name", word)
        elif word == "(":
            tree = self.expression()
            if not self.take(")"):
                raise TemplateError("')' is missing")
        else:
            raise TemplateError(f"unexpected {word!r}")
        while op := self.take(".", "[", "|"):
            if op == ".":
                tree = ("pick", tree, ("const", self.need("name")))
            elif op == "[":
                tree = ("pick", tree, self.expression())
                if not self.take("]"):
                    raise TemplateError("']' is missing")
            elif (name := self.need("name")) in FILTERS:
                tree = ("filter", name, tree)
            else:
                raise TemplateError(f"no filter {name!r}")
        return tree


def parse(template: str) -> list:
    """Statements as tuples: text, show, set, for, if, generation."""
    parts, trim = [], False
    for k, piece in enumerate(MARKS.split(template)):
        if k % 2:
            if piece[2] == "-" and parts and parts[-1][0] == "text":
                parts[-1] = ("text", parts[-1][1].rstrip())
            trim = piece[-3] == "-"
            if piece[1] != "#":
                parts.append(("mark" if piece[1] == "%" else "show", piece[2:-2].strip("-").strip()))
        else:
            parts.append(("text", piece.lstrip() if trim else piece))
    at = 0

    def body(*ends: str) -> tuple[list, str, str]:
        nonlocal at
        out = []
        while at < len(parts):
            kind, piece = parts[at]
            at += 1
            if kind == "text":
                out.append(("text", piece))
            elif kind == "show":
                p = Parser(piece)
                out.append(("show", p.expression()))
                p.end()
            else:
                word, _, rest = piece.partition(" ")
                if word in ends:
                    return out, word, rest
                out.append(statement(word, Parser(rest)))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return out, "", ""

    def statement(word: str, p: Parser):
        if word == "for":
            name = p.need("name")
            if not p.take("in"):
                raise TemplateError("'in' is missing")
            over = p.expression()
            p.end()
            return "for", name, over, body("endfor")[0]
        if word == "if":
            arms, test = [], p.expression()
            p.end()
            while True:
                inner, word, rest = body("elif", "else", "endif")
                arms.append((test, inner))
                if word == "endif":
                    return "if", arms
                if test == ("const", True) and arms[-1][0] is test and word == "else":
                    raise TemplateError("'else' twice")
                p = Parser(rest)
                test = p.expression() if word == "elif" else ("const", True)
                p.end()
        if word == "set":
            name = p.need("name")
            if not p.take("="):
                raise TemplateError("'=' is missing")
            tree = p.expression()
            p.end()
            return "set", name, tree
        if word == "generation":
            p.end()
            return "generation", body("endgeneration")[0]
        raise TemplateError(f"unknown statement {word!r}")

    return body()[0]


def fold(tree):
    """Evaluate what is constant; a failing constant is left for the run to report."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    parts = tuple(fold(x) if isinstance(x, tuple) else x for x in tree)
    args = [x for x in parts if isinstance(x, tuple)]
    if kind in ("and", "or") and args[0][0] == "const":
        return args[1] if bool(args[0][1]) == (kind == "and") else args[0]
    if all(x[0] == "const" for x in args):
        try:
            return ("const", evaluator(parts)({}))
        except (TypeError, TemplateError):
            pass
    return parts


def fold_body(body: list) -> list:
    """Fold expressions, drop branches that can't run, join neighbouring texts."""
    out = []

    def add(*nodes):
        for n in nodes:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            elif n != ("text", ""):
                out.append(n)

    for node in body:
        if node[0] == "show":
            tree = fold(node[1])
            add(("text", shown(tree[1])) if tree[0] == "const" else ("show", tree))
        elif node[0] == "set":
            add(("set", node[1], fold(node[2])))
        elif node[0] == "for":
            add(("for", node[1], fold(node[2]), fold_body(node[3])))
        elif node[0] == "generation":
            add(("generation", fold_body(node[1])))
        elif node[0] == "if":
            arms = []
            for test, inner in node[1]:
                test = fold(test)
                if test[0] != "const" or test[1]:
                    arms.append((test, fold_body(inner)))
                if test[0] == "const" and test[1]:
                    break
            if arms and arms[0][0][0] == "const":
                add(*arms[0][1])
            elif arms:
                add(("if", arms))
        else:
            add(node)
    return out


def evaluator(tree) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        return lambda env, v=tree[1]: v
    if kind == "name":
        return lambda env, n=tree[1]: env.get(n)
    if kind == "pick":
        of, key = evaluator(tree[1]), evaluator(tree[2])
        return lambda env: pick(of(env), key(env))
    if kind == "filter":
        f, of = FILTERS[tree[1]], evaluator(tree[2])
        return lambda env: f(shown(of(env)))
    if kind == "not":
        of = evaluator(tree[1])
        return lambda env: not of(env)
    if kind == "binary":
        f, a, b = BINARY[tree[1]], evaluator(tree[2]), evaluator(tree[3])
        return lambda env: f(a(env), b(env))
    a, b = evaluator(tree[1]), evaluator(tree[2])
    return (lambda env: a(env) and b(env)) if kind == "and" else lambda env: a(env) or b(env)


Segments = Iterator[tuple[str, bool]]


def renderer(body: list) -> Callable[[dict, bool], Segments]:
    steps = [_step(n) for n in body]

    def run(env: dict, masked: bool) -> Segments:
        for s in steps:
            yield from s(env, masked)
    return run


def _step(node) -> Callable[[dict, bool], Segments]:
    kind = node[0]
    if kind == "text":
        return lambda env, masked, t=node[1]: ((t, masked),)
    if kind == "show":
        value = evaluator(node[1])
        return lambda env, masked: ((shown(value(env)), masked),)
    if kind == "generation":
        inner = renderer(node[1])
        return lambda env, masked: inner(env, True)
    if kind == "set":
        value = evaluator(node[2])

        def assign(env, masked, name=node[1]):
            env[name] = value(env)
            return ()
        return assign
    if kind == "if":
        arms = [(evaluator(t), renderer(b)) for t, b in node[1]]

        def branch(env, masked):
            for test, inner in arms:
                if test(env):
                    return inner(env, masked)
            return ()
        return branch
    over, inner = evaluator(node[2]), renderer(node[3])

    def loop(env, masked, name=node[1]):
        items, k = iter(over(env) or ()), 0
        item = next(items, items)  # the iterator itself marks the end
        while item is not items:
            after = next(items, items)
            scope = env | {name: item, "loop": {"index": k + 1, "index0": k, "first": k == 0, "last": after is items}}
            yield from inner(scope, masked)
            item, k = after, k + 1
    return loop


def compile_template(template: str) -> Callable[[dict], Segments]:
    """Template text to a function from an environment to (text, under mask) segments."""
    run = renderer(fold_body(parse(template)))
    return lambda env: run(dict(env), False)


# ---------------------------------------------------------------- over tables

#: Control strings are <s>, [INST], [SAY], [/INST] and </s>; roles and texts are guarded, so none stands inside them.
TEMPLATE = """\
{%- for m in messages -%}
<s>{{ m.role | guard }}
{%- if m.role == 'assistant' -%}
[SAY]{% generation %}{{ m.text | guard }}{% endgeneration %}</s>
{%- else -%}
[INST]{{ m.text | guard }}[/INST]
{%- endif -%}
{%- endfor -%}"""
TURN = re.compile(r"<s>((?:[^\\<\[]|\\.)*)(?:\[INST\]((?:[^\\<\[]|\\.)*)\[/INST\]|\[SAY\]((?:[^\\<\[]|\\.)*)</s>)", re.S)
CHUNK = 1 << 18
CHUNKS = "conv_id long, chunk int, formatted string, loss_spans array<struct<start: long, stop: long>>"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Rows by turn to formatted text with the spans (code points from the conversation's start) under
    the loss mask.

    A conversation's rows meet in one task, sorted, and are rendered as they stream by; one longer than
    ``CHUNK`` characters comes out in consecutive chunks, so neither a task nor a row holds all of it.
    """
    bounded_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        flow = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))))
        out, held = [], 0
        for conv, turns in groupby(flow, key=lambda r: r[0]):
            text, spans, start, at, chunk = [], [], 0, 0, 0
            for piece, masked in render({"messages": ({"role": r, "text": t} for _, r, t in turns)}):
                text.append(piece)
                if masked and piece:
                    spans.append({"start": at, "stop": at + len(piece)})
                at += len(piece)
                if at - start >= CHUNK:
                    yield _chunks([*out, (conv, chunk, "".join(text), spans)])
                    text, spans, start, chunk, out, held = [], [], at, chunk + 1, [], 0
            out.append((conv, chunk, "".join(text), spans))
            held += at - start
            if held >= CHUNK or len(out) >= 4096:
                yield _chunks(out)
                out, held = [], 0
        if out:
            yield _chunks(out)

    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, CHUNKS))


def _chunks(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                      names=["conv_id", "chunk", "formatted", "loss_spans"])


def read_back(chunks: DataFrame) -> DataFrame:
    """Digests of turns and loss text, parsed from the formatted text and its spans alone.

    Chunks are read in the order in which ``format_conversations`` made them (a narrow step after it), a turn at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flow = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        out = []
        for conv, parts in groupby(flow, key=lambda r: r[0]):
            turns, loss, n, chars, at, rest = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, ""
            for _, _, text, spans in parts:
                for s in spans:
                    said = unguard(text[s["start"] - at:s["stop"] - at])
                    chars += len(said)
                    loss.update(said.encode())
                at += len(text)
                rest, end = rest + text, 0
                while m := TURN.match(rest, end):
                    role, body = unguard(m[1]), unguard(m[2] if m[2] is not None else m[3])
                    turns.update(f"{role}\n{body}\n".encode())
                    n, end = n + 1, m.end()
                rest = rest[end:]
            if rest:
                raise ValueError(f"conversation {conv}: text that is no turn")
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), at))
            if len(out) >= 4096:
                yield _digests(out)
                out = []
        if out:
            yield _digests(out)

    return chunks.mapInArrow(run, DIGEST)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                      names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
