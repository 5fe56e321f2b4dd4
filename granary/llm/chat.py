"""Chat formatting: a sandboxed template language, parsed to a tree, constants folded, compiled to Python closures that render turns and generation markers."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

#: Each turn is marked; an assistant's text lies between generation markers, which are the loss mask.
TEMPLATE = "{% if role == 'assistant' %}{{ '[TURN]' + 'assistant' }}[TEXT]{% generation %}{{ text | escape }}{% endgeneration %}</s>{% else %}[TURN]{{ role | escape }}[TEXT]{{ text | escape }}</s>{% endif %}\n"
#: Strings that control a format; the first letter of each gets an escape mark inside texts. ESC itself is doubled.
CONTROL = ("[TURN]", "[TEXT]", "</s>", "<s>", "[INST]", "[/INST]")
ESC = "\\"
_ESCAPE = re.compile("|".join(map(re.escape, (ESC, *CONTROL))))


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: ESC + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}
_TOKEN = re.compile(r"\s*(?:('[^']*'|\"[^\"]*\")|([A-Za-z_]\w*)|(==|!=|[|+()]))")


class TemplateError(ValueError):
    pass


def _tokens(src: str) -> list[str]:
    out, at = [], 0
    while src[at:].strip():
        m = _TOKEN.match(src, at)
        if not m:
            raise TemplateError(f"unexpected: {src[at:]!r}")
        out.append(m[0].strip())
        at = m.end()
    return out


def _expression(src: str):
    """compare := sum (('=='|'!=') sum)?; sum := piped ('+' piped)*; piped := atom ('|' filter)*. Only strings, the variables of a turn and the listed filters: no attribute, call or index exists."""
    t = _tokens(src)

    def atom():
        if not t:
            raise TemplateError("expression ends early")
        x = t.pop(0)
        if x == "(":
            e = compare()
            if not t or t.pop(0) != ")":
                raise TemplateError("missing )")
            return e
        if x[0] in "'\"":
            return ("const", x[1:-1])
        if x in ("role", "text"):
            return ("var", x)
        raise TemplateError(f"unknown name {x!r}")

    def piped():
        e = atom()
        while t and t[0] == "|":
            t.pop(0)
            name = t.pop(0) if t else ""
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            e = ("filter", name, e)
        return e

    def add():
        e = piped()
        while t and t[0] == "+":
            t.pop(0)
            e = ("add", e, piped())
        return e

    def compare():
        e = add()
        if t and t[0] in ("==", "!="):
            e = (t.pop(0), e, add())
        return e

    e = compare()
    if t:
        raise TemplateError(f"unexpected {t[0]!r}")
    return e


def parse(src: str) -> list:
    """Syntax tree of text, {{ }}, {% if %}{% else %}{% endif %} and {% generation %}."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", src, flags=re.S)

    def block(until: tuple[str, ...]):
        out = []
        while parts:
            x = parts.pop(0)
            if x.startswith("{{"):
                out.append(("out", _expression(x[2:-2])))
            elif x.startswith("{%"):
                word, _, rest = x[2:-2].strip().partition(" ")
                if word in until:
                    return out, word
                if word == "if":
                    test = _expression(rest)
                    then, end = block(("else", "endif"))
                    other = block(("endif",))[0] if end == "else" else []
                    out.append(("if", test, then, other))
                elif word == "generation":
                    out.append(("gen", block(("endgeneration",))[0]))
                else:
                    raise TemplateError(f"unknown tag {word!r}")
            elif x:
                out.append(("out", ("const", x)))
        if until:
            raise TemplateError(f"missing {until[-1]}")
        return out, ""

    return block(())[0]


def fold(node):
    """Constants folded: expressions of constants, tests of constants, neighbouring texts."""
    if isinstance(node, list):
        out = []
        for x in map(fold, node):
            for y in x[1] if x[0] == "many" else [x]:
                if out and y[0] == out[-1][0] == "out" and y[1][0] == out[-1][1][0] == "const":
                    out[-1] = ("out", ("const", out[-1][1][1] + y[1][1]))
                else:
                    out.append(y)
        return out
    kind = node[0]
    if kind == "out":
        return ("out", fold(node[1]))
    if kind == "gen":
        return ("gen", fold(node[1]))
    if kind == "if":
        test = fold(node[1])
        return ("many", fold(node[2] if test[1] else node[3])) if test[0] == "const" else ("if", test, fold(node[2]), fold(node[3]))
    if kind in ("add", "==", "!="):
        a, b = fold(node[1]), fold(node[2])
        if a[0] == b[0] == "const":
            return ("const", a[1] + b[1] if kind == "add" else (a[1] == b[1]) == (kind == "=="))
        return (kind, a, b)
    if kind == "filter":
        a = fold(node[2])
        return ("const", FILTERS[node[1]](a[1])) if a[0] == "const" else ("filter", node[1], a)
    return node


def _value(e):
    kind = e[0]
    if kind == "const":
        return lambda role, text, x=e[1]: x
    if kind == "var":
        return (lambda role, text: role) if e[1] == "role" else (lambda role, text: text)
    if kind == "filter":
        f, a = FILTERS[e[1]], _value(e[2])
        return lambda role, text: f(a(role, text))
    a, b = _value(e[1]), _value(e[2])
    if kind == "add":
        return lambda role, text: a(role, text) + b(role, text)
    return (lambda role, text: a(role, text) == b(role, text)) if kind == "==" else (lambda role, text: a(role, text) != b(role, text))


def _block(nodes: list):
    """A closure that appends (text, in the loss mask) pieces."""
    steps = []
    for n in nodes:
        if n[0] == "out":
            steps.append(lambda role, text, put, gen, f=_value(n[1]): put((f(role, text), gen)))
        elif n[0] == "gen":
            steps.append(lambda role, text, put, gen, f=_block(n[1]): f(role, text, put, True))
        else:
            steps.append(lambda role, text, put, gen, t=_value(n[1]), a=_block(n[2]), b=_block(n[3]): (a if t(role, text) else b)(role, text, put, gen))

    def run(role, text, put, gen):
        for s in steps:
            s(role, text, put, gen)

    return run


def compile_template(src: str = TEMPLATE):
    """A function (role, text) -> (formatted turn, [(start, end) under the loss mask])."""
    body = _block(fold(parse(src)))

    def render(role: str, text: str):
        pieces: list[tuple[str, bool]] = []
        body(role, text, pieces.append, False)
        at, spans = 0, []
        for s, gen in pieces:
            if gen:
                spans.append((at, at + len(s)))
            at += len(s)
        return "".join(s for s, _ in pieces), spans

    return render


_READ = re.compile(r"\[TURN\]((?:\\.|[^\\])*?)\[TEXT\]((?:\\.|[^\\])*?)</s>\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of formatted text; raises unless every character is accounted for."""
    out, at = [], 0
    for m in _READ.finditer(formatted):
        if m.start() != at:
            break
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation at {at}")
    return out


def formatted_turns(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, turn, role, formatted, loss_spans: each turn rendered on its own, in parallel, however long its conversation is."""
    from granary.llm.common import arrow_map

    def make():
        render = compile_template(template)

        def f(b):
            out = [render(r or "", t or "") for r, t in zip(b["role"], b["text"])]
            return b | {"formatted": [x[0] for x in out], "loss_spans": [[y for s in x[1] for y in s] for x in out]}

        return f

    k = conversations.schema
    return arrow_map(conversations.select("conv_id", "turn", "role", "text"), make, f"conv_id {k['conv_id'].dataType.simpleString()}, turn {k['turn'].dataType.simpleString()}, role string, text string, formatted string, loss_spans array<int>")


def digests(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the formatted turns.

    Turns go in order of (turn, role, text), nulls first. They are sorted within partitions and streamed: a task holds one batch and the running digests, so a conversation may be far larger than memory. Null role or text: empty. Null conv_id: one conversation. Equal rows: each a turn. Empty table: no rows.
    """
    turns = formatted_turns(conversations, template).select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "formatted", "loss_spans")
    turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "formatted", "loss_spans")
    schema = f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    kind = _parse_datatype_string(schema)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        out, state = to_arrow_schema(kind), None

        def row(s):
            return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])

        for b in batches:
            done = []
            for conv, text, spans in zip(*(c.to_pylist() for c in b.columns)):
                if state is None or state[0] != conv:
                    if state:
                        done.append(row(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_back(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for s, e in zip(spans[::2], spans[1::2]):
                    learned = unescape(text[s:e])
                    state[3] += len(learned)
                    state[4].update(learned.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], f.type) for i, f in enumerate(out)], schema=out)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row(state), out)], schema=out)

    return turns.mapInArrow(run, kind)


#: The conversation that the query adds: both turns look like control strings.
EXTRA = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]

_ESC = "replace(replace(replace(replace(replace(replace(replace({0}, '\\', '\\\\'), '[TURN]', '\\[TURN]'), '[TEXT]', '\\[TEXT]'), '</s>', '\\</s>'), '<s>', '\\<s>'), '[INST]', '\\[INST]'), '[/INST]', '\\[/INST]')"
SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(6 + 6 + 4 + 1 + length({_ESC.format('role')}) + length({_ESC.format('text')}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
