"""Chat formatting: records of several layouts to canonical turns, and turns to one marked, reversible text.

Schema fingerprinting chooses the conversion. The nested paths of the fields that a record holds (`messages[].role`,
`instruction`, ...) are hashed; the hash looks up a declared `Layout`, whose mapping names the fields that hold
roles and texts. A record whose paths no layout declares has no layout and no turns, rather than guessed ones. Everything is
column expressions; conversions run row by row without a shuffle.

A turn is written as `### Role: text</turn>` and a line feed. Control strings inside texts and roles are escaped
with backslashes, so a mark in the output is always a mark, and reading back gives every text exactly. The loss mask has an entry
per turn: `skip` code points of header, `chars` code points of text, and whether the text is to be learnt.

Defined results: null texts and roles are empty strings; absent optional fields give no turn; an empty
or null list of messages gives no turns and an empty text; other columns stay, an input column with the name of a new one is
replaced. `conversations_of` gathers rows into conversations, by turn, role and text (null turns first, repeated rows all
kept); a null id is a conversation of its own. One conversation is one row and has to fit into a task; `written` formats single
turns where that is too much.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

#: The template's marks, and the roles that have a name of their own in it.
HEAD, AFTER_ROLE, END = "### ", ": ", "</turn>"
NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
#: Other roles are written as they are, after this.
OTHER = "="
#: What is escaped, in this order. Afterwards a backslash stands only before -, /, # or ;
ESCAPES = (("\\", "\\-"), ("</", "<\\/"), ("##", "#\\#"))
ROLE_ESCAPE = (":", "\\;")
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Said:
    """A turn by a fixed role; its text is the named fields that are present, a blank line between them."""

    role: str
    fields: tuple[str, ...]
    optional: tuple[str, ...] = ()


@dataclass(frozen=True)
class Each:
    """A turn per element of a list; `roles` renames the list's roles. `text` may be a list of parts (`content[].text`)."""

    items: str
    role: str
    text: str
    roles: dict[str, str] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Layout:
    name: str
    turns: tuple[Said | Each, ...]

    def path_sets(self) -> list[frozenset[str]]:
        """Every set of present paths that is this layout."""
        always, maybe = set(), []
        for t in self.turns:
            if isinstance(t, Said):
                always |= set(t.fields) - set(t.optional)
                maybe += t.optional
            else:
                whole = f"{t.items}[]"
                always.add(whole)
                maybe += [f"{whole}.{t.role}", f"{whole}.{t.text}"]
                if "[]" in t.text:
                    maybe.append(f"{whole}.{t.text.split('[]')[0]}[]")
        return [frozenset(always | set(some)) for n in range(len(maybe) + 1) for some in combinations(maybe, n)]


#: Layouts that are known by their fields.
LAYOUTS = (
    Layout("prompt", (Said("system", ("system",), ("system",)), Said("user", ("prompt",)), Said("assistant", ("completion",)))),
    Layout("instruction", (
        Said("system", ("system",), ("system",)), Said("user", ("instruction", "input"), ("input",)), Said("assistant", ("output",)))),
    Layout("question", (Said("system", ("system",), ("system",)), Said("user", ("question",)), Said("assistant", ("answer",)))),
    Layout("messages", (Each("messages", "role", "content"),)),
    Layout("message_parts", (Each("messages", "role", "content[].text"),)),
    Layout("from_value", (Each("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),)),
)


def _has(element: DataType, path: str, k: int):
    """Whether an element has the k-th of its paths."""
    return lambda x: present_paths(element, x, path)[k][1]


def present_paths(kind: DataType, value: Column, path: str = "") -> list[tuple[str, Column]]:
    """(path, whether a record has it) of every field: leaves that are not null, and lists that are not null (`name[]`)."""
    if isinstance(kind, StructType):
        return [
            found for f in kind
            for found in present_paths(f.dataType, value.getField(f.name), f"{path}.{f.name}" if path else f.name)]
    if isinstance(kind, ArrayType):
        inner = present_paths(kind.elementType, F.lit(None).cast(kind.elementType), f"{path}[]")
        found = [(f"{path}[]", value.isNotNull())]
        if isinstance(kind.elementType, (StructType, ArrayType)):
            for k, (name, _) in enumerate(inner):
                found.append((name, F.coalesce(F.exists(value, _has(kind.elementType, f"{path}[]", k)), F.lit(False))))
        return found
    return [(path, value.isNotNull())]


def fingerprint(kind: StructType, value: Column, ignored: Sequence[str] = ()) -> Column:
    """The hash of a record's present paths, in order of their names."""
    paths = sorted((p, has) for p, has in present_paths(kind, value) if p not in ignored)
    return F.xxhash64(F.concat_ws("\n", *[F.when(has, F.lit(p)) for p, has in paths])) if paths else F.xxhash64(F.lit(""))


def _text(kind: DataType | None, value: Column) -> Column:
    """A field's text: strings and numbers as they are, anything nested as JSON."""
    if kind is None:
        return F.lit(None).cast("string")
    return F.to_json(value) if isinstance(kind, (StructType, ArrayType)) else value.cast("string")


def _field(kind: DataType, value: Column, name: str) -> Column:
    """The text of a field of a struct, joined if it is a list of parts; null where the schema has no such field."""
    first, parts, rest = name.partition("[].")
    known = {f.name: f.dataType for f in kind} if isinstance(kind, StructType) else {}
    if first not in known:
        return F.lit(None).cast("string")
    if not parts:
        return _text(known[first], value.getField(first))
    if not isinstance(known[first], ArrayType):
        return F.lit(None).cast("string")
    element = known[first].elementType
    return F.array_join(F.transform(value.getField(first), lambda x: F.coalesce(_field(element, x, rest), F.lit(""))), "")


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _message(each: Each, element: StructType):
    """An element of a list of messages to a turn."""
    names = F.create_map(*[F.lit(x) for pair in each.roles.items() for x in pair]) if each.roles else None

    def turn(m: Column) -> Column:
        role = _field(element, m, each.role)
        return _turn(role if names is None else F.coalesce(F.try_element_at(names, role), role), _field(element, m, each.text))

    return turn


def _turns(layout: Layout, kind: StructType, record: Column) -> Column:
    parts = []
    for t in layout.turns:
        if isinstance(t, Said):
            texts = [_field(kind, record, f) for f in t.fields]
            said = _turn(F.lit(t.role), F.concat_ws("\n\n", *texts))
            parts.append(F.array_compact(F.array(F.when(F.coalesce(*texts).isNotNull(), said))))
            continue
        known = {f.name: f.dataType for f in kind}.get(t.items)
        if not isinstance(known, ArrayType) or not isinstance(known.elementType, StructType):
            continue
        parts.append(F.transform(record.getField(t.items), _message(t, known.elementType)))
    return F.concat(*[p.cast(TURNS) for p in parts]) if parts else F.array().cast(TURNS)


def canonical(df: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS, ignored: Sequence[str] = ()) -> DataFrame:
    """`df` with layout (null if no layout has just these fields) and turns, from the struct column `record`.

    `ignored` paths (ids, sources) are left out of the fingerprint.
    """
    kind = df.schema[record].dataType
    if not isinstance(kind, StructType):
        raise TypeError(f"{record} is no struct")
    taken: dict[frozenset, str] = {}
    for layout in layouts:
        sets = layout.path_sets()
        if sets[-1] in taken:
            raise ValueError(f"{layout.name} and {taken[sets[-1]]} have the same fields")
        for paths in sets:  # lists without any text are the same to several layouts
            taken.setdefault(paths, layout.name)
    lookup = F.create_map(*[
        x for paths, name in taken.items() for x in (F.xxhash64(F.lit("\n".join(sorted(paths)))), F.lit(name))])
    kept = [c for c in df.columns if c.lower() not in ("layout", "turns")]
    chosen = F.try_element_at(lookup, fingerprint(kind, F.col(record), ignored))
    held = df.select(*kept, F.col(record).alias("turns"), F.explode(F.array(chosen)).alias("layout"))
    turns = F.lit(None).cast(TURNS)
    for layout in reversed(layouts):
        turns = F.when(F.col("layout") == layout.name, _turns(layout, kind, F.col("turns"))).otherwise(turns)
    return held.select(*kept, "layout", turns.alias("turns"))


def escaped(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def _header(role: Column) -> Column:
    safe = F.replace(escaped(role), *map(F.lit, ROLE_ESCAPE))
    named = F.coalesce(
        *[F.when(role == r, F.lit(n)) for r, n in NAMES.items()], F.concat(F.lit(OTHER), safe))
    return F.concat(F.lit(HEAD), named, F.lit(AFTER_ROLE))


def written(role: Column, text: Column) -> Column:
    """One turn as text."""
    return F.concat(_header(role), escaped(text), F.lit(END + "\n"))


def format_turns(df: DataFrame, learnt: Sequence[str] = ("assistant",)) -> DataFrame:
    """`df` with formatted and mask, from its column turns (an array of role and text; null: null)."""
    kept = [c for c in df.columns if c.lower() not in ("formatted", "mask")]
    entry = lambda t: F.struct(
        F.length(_header(t["role"])).alias("skip"), F.length(escaped(t["text"])).alias("chars"),
        t["role"].isin(*learnt).alias("loss"))
    return df.select(
        *kept, F.array_join(F.transform("turns", lambda t: written(t["role"], t["text"])), "").alias("formatted"),
        F.transform("turns", entry).alias("mask"))


def _pieces(formatted: Column) -> Column:
    """The turns as they are written, without their ends."""
    parts = F.split(formatted, END + "\n", -1)
    return F.slice(parts, 1, F.size(parts) - 1)


def _read_turn(piece: Column) -> Column:
    mark = F.instr(piece, AFTER_ROLE)  # an escaped role has no colon
    name = F.substring(piece, F.lit(len(HEAD) + 1), mark - (len(HEAD) + 1))
    other = F.replace(F.substring(name, F.lit(2), F.length(name)), *map(F.lit, reversed(ROLE_ESCAPE)))
    role = F.coalesce(*[F.when(name == n, F.lit(r)) for r, n in NAMES.items()], unescaped(other))
    text = unescaped(F.substring(piece, mark + len(AFTER_ROLE), F.length(piece)))
    return F.struct(role.alias("role"), text.alias("text"))


def read_back(df: DataFrame) -> DataFrame:
    """`df` with turns and learnt (all text under the mask, joined), both from its columns formatted and mask alone."""
    kept = [c for c in df.columns if c.lower() not in ("turns", "learnt")]
    learnt = F.zip_with(_pieces(F.col("formatted")), "mask", lambda piece, m: F.when(
        m["loss"], unescaped(F.substring(piece, m["skip"] + 1, m["chars"]))).otherwise(F.lit("")))
    return df.select(
        *kept, F.transform(_pieces(F.col("formatted")), _read_turn).alias("turns"), F.array_join(learnt, "").alias("learnt"))


def conversations_of(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation, with its turns: (`conv`, turns).

    Rows are gathered in every task first, so a conversation reaches the shuffle as one row per task.
    """
    said = F.struct(
        F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast(StringType()), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast(StringType()), F.lit("")).alias("text"))
    gathered = rows.groupBy(conv).agg(F.sort_array(F.collect_list(said)).alias("turns"))
    return gathered.select(conv, F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
