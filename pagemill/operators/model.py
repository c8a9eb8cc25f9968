"""Calls of an outside model as a map over partitions: one client a worker, retries, and a record of usage.

The client is any callable prompt -> answer, built on the worker by a factory, so nothing that can't be pickled travels and
no model is needed where none is there.  Answers that loop (repeated lines) are asked for once more."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Attempts and the waits between them.
WAITS = (1, 4)


def repeated(text: str) -> tuple[float, bool]:
    """Share of repeated lines over 20 characters, and whether it is out of the ordinary."""
    lines = pd.Series([x.strip() for x in text.splitlines()], dtype=object)
    lines = lines[lines.str.len() > 20] if len(lines) else lines
    if lines.empty:
        return 0.0, False
    counts = lines.value_counts()
    ratio = 1 - len(counts) / len(lines)
    return round(ratio, 3), bool((len(lines) >= 8 and ratio > 0.5) or counts.iloc[0] >= 5)


def ask(client: Callable[[str], str], prompt: str, pause: Callable[[float], None] = time.sleep) -> tuple[str, int, str | None]:
    """Answer, attempts and error.  Only lost connections are tried again."""
    for attempt in range(len(WAITS) + 1):
        try:
            answer = client(prompt)
            if repeated(answer)[1] and attempt == 0:
                retry = client(prompt)
                answer = retry if repeated(retry)[0] <= repeated(answer)[0] else answer
                return answer, 2, None
            return answer, attempt + 1, None
        except (ConnectionError, TimeoutError) as e:
            if attempt == len(WAITS):
                return "", attempt + 1, type(e).__name__
            pause(WAITS[attempt])
    raise AssertionError


def call_model(prompts: DataFrame, factory: Callable[[], Callable[[str], str]], *, key: str, prompt: str = "prompt") -> DataFrame:
    """(key, answer, attempts, prompt_tokens, output_tokens, error) for each prompt; a null prompt is not sent."""
    kind = prompts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for batch in batches:
            rows = [ask(client, p) if isinstance(p, str) else ("", 0, "no prompt") for p in batch[prompt]]
            tokens = lambda t: 0 if not t else max(1, round(len(t) / 4))
            yield pd.DataFrame(
                {key: batch[key], "answer": [r[0] for r in rows], "attempts": [r[1] for r in rows], "prompt_tokens": [tokens(p) if isinstance(p, str) else 0 for p in batch[prompt]],
                 "output_tokens": [tokens(r[0]) for r in rows], "error": [r[2] for r in rows]}
            )

    return prompts.select(key, prompt).mapInPandas(run, f"{key} {kind}, answer string, attempts int, prompt_tokens int, output_tokens int, error string")
