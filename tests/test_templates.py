"""Edge records (FIXTURES.md §4) rendered by Spark, against the literal texts expected."""

import pytest

from corpusmill.config import ConfigError, MixSpec, SourceSpec
from corpusmill.functions.templates import CHATML, ChatTemplate, render
from corpusmill.functions.text import WHITESPACE, in_length_band, strip_ws
from corpusmill.plans.prepare import render_sources

ALP = "instruction string, input string, output string"


def _texts(df, fmt, **kw):
    return [r[0] for r in df.select(render(df, fmt, **kw).alias("t")).collect()]


def test_whitespace_set_is_python_isspace():
    expected = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert WHITESPACE == expected


def test_strip_unicode_whitespace(spark):
    raw = "　 \u001c\tbody text​\t　"
    got = spark.createDataFrame([(raw,)], "t string").select(strip_ws("t")).first()[0]
    assert got == raw.strip() == "body text​"


def test_length_bounds_and_strip_before_length(spark):
    vals = ["a" * 50, "b" * 51, "c" * 8191, "d" * 8192, "e" * 50 + " " * 10, "\U0001F600" * 51]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    kept = [r[0] for r in df.select(strip_ws("t").alias("t")).where(in_length_band("t")).collect()]
    assert sorted(kept) == ["b" * 51, "c" * 8191, "\U0001F600" * 51]


def test_alpaca_input_truthiness(spark):
    rows = [("i", "", "o"), ("i", None, "o"), ("i", " ", "o"), ("i", "x", None), (None, None, None)]
    df = spark.createDataFrame(rows, ALP)
    got = _texts(df, "alpaca")
    assert got == [
        "### Instruction:\ni\n\n### Response:\no",
        "### Instruction:\ni\n\n### Response:\no",
        "### Instruction:\ni\n\n### Input:\n \n\n### Response:\no",
        "### Instruction:\ni\n\n### Input:\nx\n\n### Response:\nNone",
        "### Instruction:\nNone\n\n### Response:\nNone",
    ]


def test_alpaca_absent_output(spark):
    df = spark.createDataFrame([("i", "")], "instruction string, input string")
    assert _texts(df, "alpaca") == ["### Instruction:\ni\n\n### Response:\n"]


def test_openorca_default_only_when_absent(spark):
    full = spark.createDataFrame([("", "q", "r"), (None, "q", "r")], "system_prompt string, question string, response string")
    got = _texts(full, "openorca")
    assert got == ["### System:\n\n\n### Instruction:\nq\n\n### Response:\nr",
                   "### System:\nNone\n\n### Instruction:\nq\n\n### Response:\nr"]
    absent = spark.createDataFrame([("q", "r")], "question string, response string")
    assert _texts(absent, "openorca") == [
        "### System:\nYou are a helpful assistant.\n\n### Instruction:\nq\n\n### Response:\nr"]


def test_chat_role_default_and_null_content(spark):
    df = spark.createDataFrame([([("hi",), (None,)],)], "messages array<struct<content:string>>")
    assert _texts(df, "chatml") == ["<|im_start|>user\nhi<|im_end|>\n<|im_start|>user\nNone<|im_end|>\n"]


def test_sharegpt_mapping(spark):
    conv = [("human", "a"), ("gpt", "b"), ("system", "c"), (None, "d")]
    df = spark.createDataFrame([(conv,)], "conversations array<struct<from:string,value:string>>")
    assert _texts(df, "chatml") == ["<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
                                    "<|im_start|>assistant\nc<|im_end|>\n<|im_start|>assistant\nd<|im_end|>\n"]


def test_messages_precedence_and_malformed(spark):
    schema = ("messages array<struct<role:string,content:string>>, "
              "conversations array<struct<from:string,value:string>>")
    rows = [
        ([("user", "m")], [("human", "c")]),      # messages win
        ([], [("human", "c")]),                   # empty messages -> conversations
        (None, None),                             # NULL conversations -> dropped
        ([], [("human", "x"), None]),             # NULL turn -> dropped
        ([], []),                                 # empty -> '' -> dropped by length
    ]
    df = spark.createDataFrame(rows, schema)
    got = _texts(df, "chatml")
    assert got == ["<|im_start|>user\nm<|im_end|>\n", "<|im_start|>user\nc<|im_end|>\n", None, None, ""]


def test_null_messages_without_fallback_is_malformed(spark):
    df = spark.createDataFrame([(None,)], "messages array<struct<role:string,content:string>>")
    assert _texts(df, "chatml") == [None]


def test_custom_template(spark):
    t = ChatTemplate(prefix="[{role}] ", suffix="\n", bos="<s>", eos="</s>", role_prefix={"system": "SYS: "})
    df = spark.createDataFrame([([("system", "s"), ("user", "u")],)], "messages array<struct<role:string,content:string>>")
    assert _texts(df, "chatml", template=t)[0] == "<s>SYS: s\n[user] u\n</s>"


def test_unknown_format_and_wrong_shape(spark):
    df = spark.createDataFrame([(1, "q", "r")], "id long, question string, response string")
    with pytest.raises(ConfigError):
        render(df, "xml")
    with pytest.raises(ConfigError):
        render(df, "alpaca")  # no alpaca field present
    # parity: without the shape check each row is a constant short text -> 0 after the band
    texts = [r[0] for r in df.select(strip_ws(render(df, "alpaca", strict_shape=False)).alias("t"))
             .where(in_length_band("t")).collect()]
    assert texts == []


def test_unknown_format_skip_gives_zero_rows(spark):
    df = spark.createDataFrame([(1, "x" * 80)], "id long, text string")
    spec = SourceSpec(name="s", format="xml", id_column="id")
    with pytest.raises(ConfigError):
        render_sources(spark, [spec], MixSpec(), {"s": df})
    rendered, _, skipped = render_sources(spark, [spec], MixSpec(on_unknown_format="skip"), {"s": df})
    assert rendered is None and "s" in skipped


def test_chatml_is_default_template():
    assert CHATML.prefix == "<|im_start|>{role}\n" and CHATML.suffix == "<|im_end|>\n"


def test_turns_of_a_conversation_in_order(spark):
    from corpusmill.sources.records import messages_records
    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(600)]
    df = spark.createDataFrame(turns[::-1], "conv_id long, turn long, role string, text string")
    got = messages_records(df).select(render(messages_records(df), "chatml").alias("t")).first()["t"]
    assert got.split("<|im_start|>")[1:3] == ["user\nt0<|im_end|>\n", "assistant\nt1<|im_end|>\n"]
    assert [x.split("\n")[1].removesuffix("<|im_end|>") for x in got.split("<|im_start|>")[1:]] == [f"t{t}" for t in range(600)]


def test_template_factory_path(spark):
    from corpusmill.operators.render import render_samples, render_with_factory

    def factory():
        def render_batch(convs):
            return [None if c is None else "|".join(f"{m['role']}={m['content']}" for m in c) + "  " for c in convs]
        return render_batch

    schema = "sample_id string, source string, messages array<struct<role:string,content:string>>"
    df = spark.createDataFrame([("a", "s", [("user", "hi"), ("assistant", None)]), ("b", "s", None)], schema)
    got = {r["sample_id"]: r["text"] for r in render_with_factory(df, factory).collect()}
    assert got == {"a": "user=hi|assistant=None", "b": None}
    # the ChatML factory equals the built-in expression
    from corpusmill.operators.render import chatml_template_factory
    a = {r["sample_id"]: r["text"] for r in render_with_factory(df, chatml_template_factory).collect()}
    b = {r["sample_id"]: r["text"] for r in render_samples(df, "chatml").collect()}
    assert a == b


def test_prepare_with_template_factory_equals_builtin(spark):
    from corpusmill.operators.render import chatml_template_factory
    from corpusmill.plans import catalog
    from corpusmill.plans.prepare import prepare
    specs, frames = catalog.mixed_format(spark, "/root/testdata/sf0.001")
    a = prepare(spark, specs, MixSpec(), frames)
    b = prepare(spark, specs, MixSpec(), frames, template_factory=chatml_template_factory)
    ra = sorted(tuple(r) for r in a.corpus.select("sample_id", "pos", "text").collect())
    rb = sorted(tuple(r) for r in b.corpus.select("sample_id", "pos", "text").collect())
    assert ra == rb and len(ra) > 0
