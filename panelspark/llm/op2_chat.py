"""Chat formatting by schema fingerprints, in DataFrame functions only.

**Layouts to turns.**  A record is a JSON text.  Its fingerprint is the hash of its nested field
paths: the shape of the parsed value without scalar types, ``OBJECT<messages: ARRAY<OBJECT<content:
_, role: _>>>``.  A fingerprint selects one declarative ``Mapping`` (required and optional paths,
and what turns they make), which gives canonical turns of (role, text).

**Template.**  A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts and roles, a control
string (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, ``<<SYS>>``, ``<</SYS>>``) gets a
backslash after its first character, and one more where backslashes stand there already, so no text
can forge a marker and ``read_back`` restores every text.  Roles also write ``%`` and line ends as
``%25`` and ``%0A``.  ``loss_runs`` gives (chars, loss) for runs of the formatted text, three a turn:
start marker with role, text, end marker; loss is true for the texts of the assistant.

Edge cases: null text, null role and missing optional fields are empty; turns with equal numbers
go by role and text; rows with a null conversation id form one conversation; repeated rows are
turns of their own; JSON that does not parse or has no mapping gives null turns and the
``mapping`` ``'invalid'`` or ``'unmapped'``, with its fingerprint kept; an array without elements
gives no turns; empty tables give empty results; extra columns are left aside.  A conversation
is one value, as its format demands, of any length that a Spark string holds: the fingerprint is
taken from a skeleton without the texts, and texts are read without the parser's limit on strings.
A skeleton that is still too long to parse (``MAX_SKELETON``) and a mapped record that cannot be read
are errors, never nulls.  Names of over 50,000 characters, numbers of over 1,000 digits and nesting
of over 1,000 levels count as not parsing.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: What follows the first character of a control string.
CONTROL = r"(?=\||/?s>|/?INST\]|</?SYS>)"

#: The inside of a valid JSON string; a string value, or a name (kept as group 1); equal flat elements in a row.
INSIDE = r'(?:[^"\\\x00-\x1F]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+'
STRINGS = f'"{INSIDE}"(?!\\s*+:)|"({INSIDE})"'
EQUAL_RUN = r"(?<=[\[,])\s*+(\{[^{}\[\]]*+\})(?:\s*+,\s*+\1)++"
#: Characters of a skeleton that are surely parsed.
MAX_SKELETON = 15_000_000


# -- schema fingerprints ----------------------------------------------------------------
def shape_of(paths: list[str]) -> str:
    """The shape of records with exactly these field paths (``a.b``, ``list[].c``)."""
    if paths == [""]:
        return "_"
    if all(p.startswith("[]") for p in paths):
        return f"ARRAY<{shape_of([p[2:].removeprefix('.') for p in paths])}>"
    heads: dict[str, list[str]] = {}
    for p in paths:
        name = min(p.split(".")[0], p.split("[")[0], key=len)
        heads.setdefault(name, []).append(p[len(name):].removeprefix("."))
    return "OBJECT<" + ", ".join(f"{k}: {shape_of(v)}" for k, v in sorted(heads.items())) + ">"


def skeleton(json: Column) -> Column:
    """JSON of the same shape with empty string values and without repeated flat elements."""
    return F.regexp_replace(F.regexp_replace(json, STRINGS, '"$1"'), EQUAL_RUN, "$1")


def shape(json: Column) -> Column:
    """The same of a JSON text; null if it does not parse."""
    bones = skeleton(json)
    of = F.schema_of_variant(F.try_parse_json(bones))
    of = F.when(of.isNull() & (F.length(bones) > MAX_SKELETON), F.raise_error(F.lit("the skeleton of a JSON text is too long to parse"))).otherwise(of)
    return F.regexp_replace(of, r"(?<=: |<|^)(?!OBJECT<|ARRAY<)[A-Z][A-Z_ ]*(\([0-9,]+\))?(?=,|>|$)", "_")


def fingerprint(of: Column) -> Column:
    return F.sha2(of, 256)


@dataclass(frozen=True)
class Mapping:
    """A layout: its field paths and the turns they make.

    turns: (role, path) pairs, or one (role path, text path) pair inside ``each``.
    """

    name: str
    required: tuple[str, ...]
    turns: tuple[tuple[str, str], ...]
    optional: tuple[str, ...] = ()
    each: str | None = None
    roles: tuple[tuple[str, str], ...] = ()

    def shapes(self) -> list[str]:
        some = chain.from_iterable(combinations(self.optional, n) for n in range(len(self.optional) + 1))
        out = [shape_of([*self.required, *more]) for more in some]
        if self.each:  # an array without elements has no paths below it
            out.append(shape_of([*(p for p in self.required if not p.startswith(self.each + "[]")), self.each + "[]"]))
        return list(dict.fromkeys(out))

    def schema(self) -> str:
        if self.each:
            return f"{self.each} array<struct<{', '.join(f'`{p}`: string' for p in self.turns[0])}>>"
        return ", ".join(f"`{p}` string" for p in (*self.required, *self.optional))

    def canonical(self, json: Column) -> Column:
        rec = F.from_json(json, self.schema(), {"mode": "FAILFAST", "maxStringLen": str((1 << 31) - 1)})
        if self.each:
            role, text = self.turns[0]
            named = F.create_map(*(F.lit(x) for x in chain.from_iterable(self.roles))) if self.roles else None

            def turn(m):
                r = F.coalesce(m[role], F.lit(""))
                return F.struct((F.coalesce(named[r], r) if self.roles else r).alias("role"), F.coalesce(m[text], F.lit("")).alias("text"))

            return F.transform(rec[self.each], turn)
        one = [F.when(rec[p].isNotNull() if p in self.optional else F.lit(True), F.struct(F.lit(r).alias("role"), F.coalesce(rec[p], F.lit("")).alias("text"))) for r, p in self.turns]
        return F.filter(F.array(*one), lambda t: t.isNotNull())


MAPPINGS = (
    Mapping("messages", ("messages[].role", "messages[].content"), (("role", "content"),), each="messages"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), (("from", "value"),), each="conversations", roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("prompt_response", ("prompt", "response"), (("system", "system"), ("user", "prompt"), ("assistant", "response")), ("system",)),
    Mapping("prompt_completion", ("prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction", ("instruction", "output"), (("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), ("system", "input")),
)


def canonical_turns(records: DataFrame, json: str = "json", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``records`` with fingerprint, mapping (its name) and turns (array of role, text)."""
    by = {hashlib.sha256(s.encode()).hexdigest(): m for m in mappings for s in m.shapes()}
    names = F.create_map(*(F.lit(x) for k, m in by.items() for x in (k, m.name)))
    out = records.withColumn("fingerprint", fingerprint(shape(F.col(json))))
    out = out.withColumn("mapping", F.when(F.col("fingerprint").isNull(), "invalid").otherwise(F.coalesce(F.try_element_at(names, F.col("fingerprint")), F.lit("unmapped"))))
    turns = F.lit(None)
    for m in mappings:
        turns = F.when(F.col("mapping") == m.name, m.canonical(F.col(json))).otherwise(turns)
    return out.withColumn("turns", turns)


# -- the template -----------------------------------------------------------------------
def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_turns(records: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``records`` with formatted (text) and loss_runs (chars, loss) from ``turns``."""
    parts = F.transform("turns", lambda t: F.struct(F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss")))
    runs = F.flatten(F.transform("__parts", lambda p: F.array(
        F.struct(F.length(p["head"]).alias("chars"), F.lit(False).alias("loss")),
        F.struct(F.length(p["body"]).alias("chars"), p["loss"].alias("loss")),
        F.struct(F.lit(len(END)).alias("chars"), F.lit(False).alias("loss")))))
    return (records.withColumn("__parts", parts)
            .withColumn("formatted", F.array_join(F.transform("__parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""))
            .withColumn("loss_runs", runs).drop("__parts"))


def read_back(formatted: DataFrame) -> DataFrame:
    """With turns_read (role, text) and loss_read (texts under the mask), from formatted and loss_runs alone."""
    pieces = F.expr(r"""filter(split(formatted, '<\\|im_end\\|>\n', -1), (p, i) -> p != '' or i < size(loss_runs) div 3)""")
    out = formatted.withColumn("__pieces", pieces).withColumn("__pieces", F.transform("__pieces", lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p))))
    out = out.withColumn("__raw", F.expr("transform(__pieces, p -> struct(substring_index(p, '\n', 1) as role, substring(p, instr(p, '\n') + 1) as text))"))
    turns = F.transform("__raw", lambda t: F.struct(unescape_role(t["role"]).alias("role"), unescape(t["text"]).alias("text")))
    under = F.expr("filter(transform(__raw, (t, i) -> if(loss_runs[3 * i + 1].loss and length(t.text) = loss_runs[3 * i + 1].chars, t.text, null)), t -> t is not null)")
    return out.withColumn("turns_read", turns).withColumn("loss_read", F.transform(under, unescape)).drop("__pieces", "__raw")


# -- conversations stored as rows -----------------------------------------------------------
def pack(rows: DataFrame) -> DataFrame:
    """(conv_id, json) of turn rows (conv_id, turn, role, text), each in the plainest layout that holds it."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    c = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    roles = F.array_join(F.transform("t", lambda x: x["role"]), ",")
    at = lambda i: F.col("t")[i]["text"]
    json = lambda **f: F.to_json(F.struct(*(v.alias(k) for k, v in f.items())))
    known = F.forall("t", lambda x: x["role"].isin("system", "user", "assistant"))
    share = F.transform("t", lambda x: F.struct(F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"), x["text"].alias("value")))
    plain = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    body = (F.when((F.size("t") == 2) & (roles == "user,assistant"), json(prompt=at(0), response=at(1)))
            .when((F.size("t") == 3) & (roles == "system,user,assistant"), json(system=at(0), instruction=at(1), output=at(2)))
            .when(known & (F.element_at("t", 1)["role"] == "system"), json(conversations=share))
            .otherwise(json(messages=plain)))
    return c.select("conv_id", body.alias("json"))


def digests() -> list:
    turns = F.array_join(F.transform("turns_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_read", "")
    return [F.size("turns_read").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
            F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars")]
