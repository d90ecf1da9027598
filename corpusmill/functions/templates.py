"""Record-to-text templates as Column expressions (no UDF).

A field that is absent from the schema takes its default; a field that is
present but NULL prints as `null_as` ('None' = f-string parity).  Rows a
row-at-a-time renderer would fail on (NULL message list, NULL turn) render
to NULL text and are dropped and counted downstream.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.config import DEFAULT_SYSTEM_PROMPT, ConfigError
from corpusmill.functions.text import strip_ws

# The template strings of the supported record formats.
ALPACA_WITH_INPUT = "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n{output}"
ALPACA_NO_INPUT = "### Instruction:\n{instruction}\n\n### Response:\n{output}"
OPENORCA = "### System:\n{system_prompt}\n\n### Instruction:\n{question}\n\n### Response:\n{response}"
CHATML_MESSAGE = "<|im_start|>{role}\n{content}<|im_end|>\n"
# ShareGPT speaker mapping: only 'human' is the user, every other value
# (including 'system' and NULL) becomes the assistant.
SHAREGPT_USER_FROM = "human"

FORMAT_FIELDS = {
    "alpaca": ("instruction", "input", "output"),
    "openorca": ("system_prompt", "question", "response"),
    "chatml": ("messages", "conversations"),
}


def _fill(template: str, values: dict[str, Column]) -> Column:
    """Substitute {name} placeholders with Columns via concat.  Only the names
    in `values` are placeholders, other braces stand for themselves;
    {{name}} is the literal text {name}."""
    names = "|".join(map(re.escape, values))
    parts, literal = [], ""
    for i, piece in enumerate(re.split(rf"\{{(\{{(?:{names})\}})\}}|\{{({names})\}}", template)):
        if i % 3 < 2:  # text, or an escaped placeholder
            literal += piece or ""
        elif piece is not None:
            parts += [F.lit(literal)] * bool(literal) + [values[piece]]
            literal = ""
    parts += [F.lit(literal)] * bool(literal or not parts)
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _field(df: DataFrame, name: str, default: str, null_as: str) -> Column:
    if name not in df.columns:
        return F.lit(default)
    return F.coalesce(F.col(name).cast("string"), F.lit(null_as))


def _struct_field(elem: Column, fields: set[str], name: str, default: str, null_as: str) -> Column:
    if name not in fields:
        return F.lit(default)
    return F.coalesce(elem[name].cast("string"), F.lit(null_as))


def check_shape(df: DataFrame, fmt: str, text_column: str = "text") -> None:
    """Plan-time error when none of a format's fields exist in the schema."""
    wanted = (text_column,) if fmt == "text" else FORMAT_FIELDS[fmt]
    if not any(c in df.columns for c in wanted):
        raise ConfigError(f"format {fmt!r} expects one of {wanted}, schema has {df.columns}")


def alpaca_text(df: DataFrame, null_as: str = "None") -> Column:
    vals = {k: _field(df, k, "", null_as) for k in ("instruction", "input", "output")}
    has_input = (F.coalesce(F.col("input").cast("string"), F.lit("")) != F.lit("")
                 if "input" in df.columns else F.lit(False))
    return F.when(has_input, _fill(ALPACA_WITH_INPUT, vals)).otherwise(_fill(ALPACA_NO_INPUT, vals))


def openorca_text(df: DataFrame, null_as: str = "None") -> Column:
    vals = {
        "system_prompt": _field(df, "system_prompt", DEFAULT_SYSTEM_PROMPT, null_as),
        "question": _field(df, "question", "", null_as),
        "response": _field(df, "response", "", null_as),
    }
    return _fill(OPENORCA, vals)


@dataclass(frozen=True)
class Piece:
    """Text of a message, put out where all conditions that are set hold: the
    message has one of `roles` (or none of `not_roles`), is the list's `first`
    or `last` or is not, follows a message of a role in `after`, and its
    content is empty or is not.  Placeholders: {role}, {content} (as it is), {json}
    (the content as a JSON string, quoted and escaped), {stripped}, {index} (from 0)."""

    text: str
    roles: tuple[str, ...] | None = None
    not_roles: tuple[str, ...] = ()
    first: bool | None = None
    last: bool | None = None
    after: tuple[str, ...] | None = None
    empty: bool | None = None

    def column(self, messages: Column, m: Column, i: Column) -> Column:
        role = m["role"]
        text = _fill(self.text, {"role": role, "content": m["content"], "stripped": strip_ws(m["content"]),
                                 "json": json_string(m["content"]), "index": i.cast("string")})
        checks = []
        if self.roles is not None:
            checks.append(role.isin(list(self.roles)))
        if self.not_roles:
            checks.append(~role.isin(list(self.not_roles)))
        for wanted, holds in ((self.first, i == 0), (self.last, i == F.size(messages) - 1), (self.empty, m["content"] == "")):
            if wanted is not None:
                checks.append(holds if wanted else ~holds)
        if self.after is not None:
            checks.append((i > 0) & F.coalesce(F.get(messages, i - 1)["role"].isin(list(self.after)), F.lit(False)))
        for check in checks:
            text = F.when(check, text).otherwise(F.lit(""))
        return text


def json_string(text: Column) -> Column:
    """A text as a JSON string."""
    return F.substring(F.to_json(F.array(text)), F.lit(2), F.length(F.to_json(F.array(text))) - 2)


@dataclass(frozen=True)
class ChatTemplate:
    """Declarative chat template: bos + per message (prefix content suffix) + eos.

    `{role}` in prefix/suffix is replaced by the message role; any other brace
    stands for itself.  Per-role overrides take precedence over the defaults.
    With `pieces` a message is its pieces one after another instead, each with conditions on
    the loop (first, last, role before) and the message; all of it becomes Column expressions.
    """

    prefix: str = CHATML_MESSAGE.partition("{content}")[0]
    suffix: str = CHATML_MESSAGE.partition("{content}")[2]
    bos: str = ""
    eos: str = ""
    role_prefix: dict = field(default_factory=dict)
    role_suffix: dict = field(default_factory=dict)
    pieces: tuple[Piece, ...] = ()

    @classmethod
    def from_mapping(cls, spec: dict) -> ChatTemplate:
        """A template out of a configuration mapping; `pieces` is a list of
        texts or of mappings with a Piece's fields."""
        own = set(cls.__dataclass_fields__)
        if not isinstance(spec, dict) or set(spec) - own:
            raise ConfigError(f"chat template: a mapping with keys of {sorted(own)} expected, got {spec!r}")

        def piece(p) -> Piece:
            if isinstance(p, str):
                return Piece(p)
            if not isinstance(p, dict) or "text" not in p or set(p) - set(Piece.__dataclass_fields__):
                raise ConfigError(f"chat template piece: a text or a mapping with keys of {sorted(Piece.__dataclass_fields__)} expected, got {p!r}")
            many = {k: (p[k],) if isinstance(p[k], str) else tuple(p[k]) for k in ("roles", "not_roles", "after") if p.get(k) is not None}
            return Piece(**{**p, **many})

        return cls(**{**spec, "pieces": tuple(map(piece, spec.get("pieces") or ()))})

    def _affix(self, default: str, overrides: dict, role: Column) -> Column:
        expr = _fill(default, {"role": role}) if default else F.lit("")
        for name, text in overrides.items():
            expr = F.when(role == F.lit(name), _fill(text, {"role": role}) if text else F.lit("")).otherwise(expr)
        return expr

    def message(self, role: Column, content: Column) -> Column:
        return F.concat(self._affix(self.prefix, self.role_prefix, role), content,
                        self._affix(self.suffix, self.role_suffix, role))

    def body(self, messages: Column) -> Column:
        """All messages, without bos and eos."""
        if self.pieces:
            each = F.transform(messages, lambda m, i: F.concat(*(p.column(messages, m, i) for p in self.pieces)))
        else:
            each = F.transform(messages, lambda m: self.message(m["role"], m["content"]))
        return F.array_join(each, "")


CHATML = ChatTemplate()


def _elem_fields(df: DataFrame, col: str) -> set[str]:
    dt = df.schema[col].dataType
    if not isinstance(dt, T.ArrayType) or not isinstance(dt.elementType, T.StructType):
        raise ConfigError(f"column {col!r} must be array<struct>, got {dt.simpleString()}")
    return set(dt.elementType.fieldNames())


def sharegpt_to_messages(df: DataFrame, col: str = "conversations", null_as: str = "None") -> Column:
    """conversations[{from, value}] -> messages[{role, content}].  NULL list or
    NULL turn -> NULL (malformed, the row is dropped)."""
    fields = _elem_fields(df, col)

    def conv(x: Column) -> Column:
        speaker = x["from"] if "from" in fields else F.lit(None).cast("string")
        role = F.when(speaker.eqNullSafe(F.lit(SHAREGPT_USER_FROM)), F.lit("user")).otherwise(F.lit("assistant"))
        content = _struct_field(x, fields, "value", "", null_as)
        return F.struct(role.alias("role"), content.alias("content"))

    arr = F.col(col)
    return F.when(arr.isNull() | F.exists(arr, lambda x: x.isNull()), F.lit(None)).otherwise(
        F.transform(arr, conv))


def normalized_messages(df: DataFrame, null_as: str = "None") -> Column:
    """The message list a chat renderer sees, as array<struct<role, content>>.

    `messages` wins when non-empty; `conversations` is the fallback only when
    that column exists.  NULL result = malformed row.
    """
    empty = F.array().cast("array<struct<role:string,content:string>>")
    if "messages" in df.columns:
        fields = _elem_fields(df, "messages")

        def norm(m: Column) -> Column:
            return F.struct(_struct_field(m, fields, "role", "user", null_as).alias("role"),
                            _struct_field(m, fields, "content", "", null_as).alias("content"))

        msgs = F.col("messages")
        own = F.when(F.exists(msgs, lambda m: m.isNull()), F.lit(None)).otherwise(F.transform(msgs, norm))
        if "conversations" in df.columns:
            return F.when(F.size(F.coalesce(msgs, F.array())) > 0, own).otherwise(
                sharegpt_to_messages(df, "conversations", null_as))
        return own  # NULL messages with no fallback column -> NULL (malformed)
    if "conversations" in df.columns:
        return sharegpt_to_messages(df, "conversations", null_as)
    return empty


def render_messages(messages: Column, template: ChatTemplate = CHATML) -> Column:
    body = template.body(messages)
    if template.bos or template.eos:
        body = F.concat(F.lit(template.bos), body, F.lit(template.eos))
    return body


def chat_text(df: DataFrame, template: ChatTemplate = CHATML, null_as: str = "None") -> Column:
    return render_messages(normalized_messages(df, null_as), template)


def render(df: DataFrame, fmt: str, *, null_as: str = "None", template: ChatTemplate = CHATML,
           text_column: str = "text", strict_shape: bool = True) -> Column:
    """Format dispatch: the text Column for a record DataFrame of format `fmt`."""
    if fmt not in ("alpaca", "chatml", "openorca", "text"):
        raise ConfigError(f"unknown format {fmt!r}")
    if strict_shape:
        check_shape(df, fmt, text_column)
    if fmt == "alpaca":
        return alpaca_text(df, null_as)
    if fmt == "openorca":
        return openorca_text(df, null_as)
    if fmt == "chatml":
        return chat_text(df, template, null_as)
    if text_column not in df.columns:
        return F.lit("")
    return F.col(text_column).cast("string")
