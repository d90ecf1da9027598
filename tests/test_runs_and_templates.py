"""Templates with conditions, complete runs, concurrent isolated sources, Arrow tokenizers, exact stream paths."""
import json
import os
import shutil
import tempfile
import threading
import time

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from corpusmill.config import ConfigError, MixSpec, SourceSpec, TrainSpec
from corpusmill.functions.templates import CHATML, ChatTemplate, Piece, render_messages
from corpusmill.functions.text import WHITESPACE
from corpusmill.operators.render import render_samples, render_with_factory
from corpusmill.operators.tokens import tokenize_with
from corpusmill.plans import catalog, jobs
from corpusmill.plans.prepare import isolated_tables
from corpusmill.session import StageStore

CHAT = "sample_id string, source string, messages array<struct<role:string,content:string>>"
CHATS = [("s/0", "s", [("system", "Be brief."), ("user", 'weather "here"?\n'), ("tool", '{"t": 3}'), ("assistant", " cold ")]),
         ("s/1", "s", [("user", "{role} {x}"), ("assistant", "")]), ("s/2", "s", []), ("s/3", "s", None),
         ("s/4", "s", [("assistant", "only"), ("tool", "é\t\\")])]


def chats(spark):
    return spark.createDataFrame(CHATS, CHAT)


def texts(df):
    return {r.sample_id: r.text for r in df.collect()}


TOOLS = ChatTemplate(bos="<s>", eos="</s>", pieces=(
    Piece('[SYS {"always": true}]', not_roles=("system",), first=True),
    Piece("[INST] {stripped} [/INST]", roles=("user",)),
    Piece('<tool_call>{"name": "{role}", "n": {index}, "arguments": {json}}</tool_call>', roles=("tool",)),
    Piece("(reply) ", roles=("assistant",), after=("tool",)),
    Piece("{content}", roles=("assistant", "system"), empty=False),
    Piece("<none>", roles=("assistant",), empty=True),
    Piece("\n", last=False), Piece("{{role}} ends", last=True)))


def python_tools():
    def tools_factory():
        """The same in plain Python."""
        def one(messages):
            out = ["<s>"]
            for i, m in enumerate(messages):
                role, content, last = m["role"], m["content"], i == len(messages) - 1
                if i == 0 and role != "system":
                    out.append('[SYS {"always": true}]')
                if role == "user":
                    out.append(f"[INST] {content.strip(WHITESPACE)} [/INST]")
                elif role == "tool":
                    out.append('<tool_call>{"name": "tool", "n": %d, "arguments": %s}</tool_call>' % (i, json.dumps(content, ensure_ascii=False)))
                elif role == "assistant" and i and messages[i - 1]["role"] == "tool":
                    out.append("(reply) ")
                if role in ("assistant", "system"):
                    out.append(content or ("<none>" if role == "assistant" else ""))
                out.append("{role} ends" if last else "\n")
            return "".join(out) + "</s>"
        return lambda batch: [None if m is None else one(m) for m in batch]
    return tools_factory


def test_tool_call_template_equals_the_factory(spark):
    df = chats(spark)
    assert texts(render_samples(df, "chatml", template=TOOLS)) == texts(render_with_factory(df, python_tools()))


def test_literal_braces_in_prefix_and_suffix(spark):
    template = ChatTemplate(prefix='{"a": 1} {role}: ', suffix=' {{role}} {} }{', role_prefix={"tool": '{"a": {"b": [1]}} '})
    got = texts(render_samples(chats(spark), "chatml", template=template))
    assert got["s/4"] == '{"a": 1} assistant: only {role} {} }{{"a": {"b": [1]}} é\t\\ {role} {} }{'


def test_pieces_of_chatml_equal_chatml(spark):
    same = ChatTemplate(pieces=(Piece("<|im_start|>{role}\n"), Piece("{content}<|im_end|>\n")))
    df = chats(spark).select("sample_id", render_messages(F.col("messages"), CHATML).alias("a"), render_messages(F.col("messages"), same).alias("b"))
    assert all(r.a == r.b for r in df.collect())


def test_template_of_a_yaml_file(spark, tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("""
datasets:
  chat_template:
    bos: "<s>"
    pieces:
      - "{role}|"
      - {text: "{content}", roles: user}
      - {text: '{"end": true}', last: true}
""")
    template = jobs.load_template(str(path))
    assert texts(render_samples(chats(spark), "chatml", template=template))["s/1"] == '<s>user|{role} {x}assistant|{"end": true}'
    path.write_text("datasets: {}\n")
    assert jobs.load_template(str(path)) is CHATML
    for bad in ({"pieces": [{"role": "x"}]}, {"prefx": ""}, ["x"], {"pieces": [3]}):
        with pytest.raises(ConfigError):
            ChatTemplate.from_mapping(bad)


def test_a_failed_run_leaves_the_last_complete_one(spark, tmp_path, monkeypatch):
    out, specs = str(tmp_path / "out"), [catalog.doc_spec(SF001, 0, 1.0)]
    assert jobs.current_outputs(spark, out) == {}

    def fail(*_, **__):
        raise OSError("storage is gone")

    with monkeypatch.context() as m:
        m.setattr(jobs, "write_stats", fail)
        with pytest.raises(OSError):
            jobs.run_prepare_job(spark, specs, out, text_export=False)
    assert jobs.current_outputs(spark, out) == {}
    first = jobs.run_prepare_job(spark, specs, out, text_export=False)
    rows = spark.read.parquet(first.paths["corpus"]).count()
    assert jobs.current_outputs(spark, out) == first.paths and rows > 0
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_stats", fail)  # the corpus of the new run is written by then
        with pytest.raises(OSError):
            jobs.run_prepare_job(spark, specs, out, MixSpec(seed=7), text_export=False)
    assert len(os.listdir(os.path.join(out, "runs"))) == 3
    paths = jobs.current_outputs(spark, out)
    assert paths == first.paths and spark.read.parquet(paths["corpus"]).count() == rows
    second = jobs.run_prepare_job(spark, specs, out, text_export=False)
    assert jobs.current_outputs(spark, out) == second.paths != first.paths
    assert spark.read.parquet(first.paths["corpus"]).count() == rows  # readers of the first run go on


def test_isolated_sources_overlap(spark):
    met, alone = threading.Barrier(4, timeout=60), []

    class Store(StageStore):
        def put(self, name, df):
            pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
            met.wait()  # four are here at the same time
            if name in ("samples_1", "samples_6"):
                raise ValueError(f"{name} cannot be read")
            alone.append((name, pool))
            return super().put(name, df)

    frames = [spark.range(i + 1) for i in range(8)]
    tables = isolated_tables(spark, Store(spark), frames, 4)
    assert [str(t) if isinstance(t, Exception) else t.count() for t in tables] == [
        1, "samples_1 cannot be read", 3, 4, 5, 6, "samples_6 cannot be read", 8]
    assert len({pool for _, pool in alone}) >= 3 and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_failing_source_delays_no_other(spark):
    done = {}

    class Store(StageStore):
        def put(self, name, df):
            if name == "samples_0":
                time.sleep(3)
                done[name] = time.time()
                raise ValueError("slow and bad")
            out = super().put(name, df)
            done[name] = time.time()
            return out

    isolated_tables(spark, Store(spark), [spark.range(3)] * 4, 2)
    assert max(done[f"samples_{i}"] for i in (1, 2, 3)) < done["samples_0"] + 60 and len(done) == 4
    assert isolated_tables(spark, Store(spark), [], 2) == []


@pytest.mark.parametrize("kind", [list, tuple])
def test_tokenizer_results_of_any_sequence_kind(spark, kind):
    rows = spark.createDataFrame([(i, "ab" * i) for i in range(1, 40)], "row_id long, text string")
    factory = lambda: lambda batch: [kind(ord(c) for c in t) for t in batch]
    got = {r.row_id: (r.input_ids, r.n_tokens) for r in tokenize_with(rows, factory, TrainSpec(max_seq_length=9)).collect()}
    assert got == {str(i): ([ord(c) for c in "ab" * i][:9], min(9, 2 * i)) for i in range(1, 40)}
    assert tokenize_with(rows.limit(0), factory).collect() == []


def test_a_stream_reads_its_table_and_no_sibling(spark):
    from corpusmill.streaming import run_available_now, stream_samples
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    d = tempfile.mkdtemp(prefix="cm-stream-")
    docs.coalesce(1).write.parquet(f"{d}/folder.parquet")
    part = next(p for p in os.listdir(f"{d}/folder.parquet") if p.startswith("part-"))
    shutil.copy(f"{d}/folder.parquet/{part}", f"{d}/file.parquet")
    for name in ("folder", "file"):
        shutil.copy(f"{d}/folder.parquet/{part}", f"{d}/{name}.parquet2")
        spec = SourceSpec(name="x", path=f"{d}/{name}.parquet", format="text", id_column="doc_id")
        stream = stream_samples(spark, spec, docs.schema, MixSpec(min_chars=0, max_chars=1 << 30))
        out = spark.read.parquet(run_available_now(stream, tempfile.mkdtemp(prefix="cm-out-")))
        assert out.count() == out.select("sample_id").distinct().count() > 100
