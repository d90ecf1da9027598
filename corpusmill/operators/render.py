"""Render records of one format to stripped sample text.

Output columns: sample_id, source, text (stripped; NULL = malformed row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.config import MixSpec
from corpusmill.functions.templates import CHATML, CHATML_MESSAGE, ChatTemplate, render
from corpusmill.functions.text import WHITESPACE, strip_ws


def render_samples(df: DataFrame, fmt: str, mix: MixSpec | None = None,
                   template: ChatTemplate = CHATML, text_column: str = "text") -> DataFrame:
    mix = mix or MixSpec()
    text = strip_ws(render(df, fmt, null_as=mix.null_as, template=template,
                           text_column=text_column, strict_shape=mix.strict_shape))
    # a row without an id cannot be sampled or joined back: malformed, counted and dropped
    text = F.when(F.col("sample_id").isNull(), F.lit(None).cast("string")).otherwise(text)
    return df.select("sample_id", "source", text.alias("text"))


def chatml_template_factory():
    """Reference factory for `render_with_factory`: ChatML in plain Python,
    equal to the built-in CHATML expression."""
    def render_batch(conversations):
        return ["".join(CHATML_MESSAGE.format(**m) for m in msgs)
                if msgs is not None else None for msgs in conversations]
    return render_batch


def render_with_factory(df: DataFrame, factory, mix: MixSpec | None = None) -> DataFrame:
    """P5 for template code no declarative ChatTemplate can express (e.g. a
    model's own template): messages are normalised by the built-in
    expressions, then `factory()` (built once per task) renders Arrow
    batches of message lists in mapInPandas.  Output as render_samples."""
    from corpusmill.functions.templates import normalized_messages
    mix = mix or MixSpec()
    msgs = normalized_messages(df, mix.null_as)
    src = df.select("sample_id", "source", msgs.alias("messages"))

    ws = WHITESPACE

    def run(batches):
        import pandas as pd
        render_batch = factory()
        for pdf in batches:
            conv = [None if m is None else [dict(role=x["role"], content=x["content"]) for x in m]
                    for m in pdf["messages"]]
            texts = render_batch(conv)
            yield pd.DataFrame({"sample_id": pdf["sample_id"], "source": pdf["source"],
                                "text": [None if t is None else t.strip(ws) for t in texts]})

    return src.mapInPandas(run, "sample_id string, source string, text string")
