"""Generation job: prompt, call, persist raw output, parse, write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from sigloom.functions import parse as ps
from sigloom.operators import infer
from sigloom.operators.chat import Template
from sigloom.sources.writers import write_items


def generate(items: DataFrame, prompt: Template, factory: Callable[[], infer.TextFunction], raw_path: str, output: str | None = None,
             n: int = 5, key: str = "item_id", keep: tuple[str, ...] = (), **kw) -> DataFrame:
    """One row per item and signal.

    Raw answers are appended under ``raw_path`` round by round, so a run that broke off goes on with what is missing;
    parsing works on the persisted answers.  With ``output`` the signals are written there and read back.
    """
    prompts = items.select(key, prompt.fill(None).alias("prompt"))
    raw = infer.resumed(prompts, "prompt", factory, raw_path, key, **kw)
    wide = infer.parsed_signals(raw.withColumnsRenamed({"result": "text_m", "error": "error_m"}), "m", n)
    signals = ps.long_signals(items.select(key, *keep).join(wide, key), key, list(keep), "signal_m", "explanation_m")
    write_items(signals, output)
    return items.sparkSession.read.parquet(output) if output else signals
