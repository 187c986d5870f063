"""What each block of a long document inherits from the blocks before it.

Between two elements the chunker remembers only how many words it holds back, how many chunks it
has closed, the section and the page. The held-back words are a small number, so a run of blocks
acts as a lookup table from the number at its start to the number at its end. Tables of
consecutive runs compose, which lets a document of any length be followed in three parallel
steps: tabulate each run of blocks, chain the tables of a document, walk each run from its start.
Element positions are 32-bit, so a document has at most 4,096 runs of 2,048 blocks of 256.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

RUN = 2048
STATE = "entry_pending int, entry_no int, entry_page int, entry_section string"


def walk(pending, words, headers, size, overlap):
    """Follow one block from a known state: (words held back, chunks closed)."""
    closed = 0
    for n, is_header in zip(words, headers):
        if is_header and pending:
            closed, pending = closed + 1, 0
        pending += n
        if pending >= size:
            closed, pending = closed + 1, min(n, overlap)
    return pending, closed


def tabulate(words, headers, size, overlap):
    """``walk`` for every possible state at once, as two arrays."""
    states = np.arange(max(size, overlap + 1))
    total = len(words)
    opening = int(np.argmax(headers)) if headers.any() else total
    ends = np.cumsum(words[:opening])
    kept = np.minimum(words[:opening], overlap)

    # Where a chunk closes settles everything after it, up to the first header.
    at_end = np.zeros(opening, np.int64)
    closed = np.ones(opening, np.int64)
    following = np.maximum(
        np.searchsorted(ends, ends - kept + size), np.arange(opening) + 1
    )
    for i in range(opening - 1, -1, -1):
        j = following[i]
        if j < opening:
            at_end[i], closed[i] = at_end[j], closed[j] + 1
        else:
            at_end[i] = kept[i] + ends[-1] - ends[i]

    first = np.searchsorted(ends, size - states)
    closes = first < opening
    leave = states + (ends[-1] if opening else 0)
    count = np.zeros_like(states)
    leave[closes], count[closes] = at_end[first[closes]], closed[first[closes]]
    if opening < total:
        pending, more = walk(0, words[opening:], headers[opening:], size, overlap)
        count += (leave > 0) + more
        leave = np.full_like(states, pending)
    return leave, count


def entry_states(
    blocks: DataFrame, documents: DataFrame, size: int, overlap: int, run: int = RUN
) -> DataFrame:
    """Entry state per (document, block) of the named ``documents``, which are distinct.

    An inner join keeps them: a semi join would be pushed below the grouping of ``blocks`` and
    shuffle the texts a second time.
    """
    overlap = max(overlap, 0)
    heads = blocks.join(documents, "document_name").select(
        "document_name",
        # Not null, or the filter that Spark infers would split the exchange of the blocks in two.
        F.coalesce(F.floor(F.col("block") / run).cast("int"), F.lit(0)).alias("run"),
        "block",
        F.transform("elements", lambda e: e.n_words).alias("words"),
        F.transform("elements", lambda e: e.is_header).alias("headers"),
        F.try_element_at(F.filter("elements", lambda e: e.is_header), F.lit(-1)).text.alias("section"),
        F.try_element_at(F.filter("elements", lambda e: e.page_no.isNotNull()), F.lit(-1))
        .page_no.alias("page"),
    )

    def tabulate_run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        leave = count = None
        for words, headers in zip(group["words"], group["headers"]):
            step, closes = tabulate(np.asarray(words), np.asarray(headers, bool), size, overlap)
            count = closes if count is None else count + closes[leave]
            leave = step if leave is None else step[leave]
        return pd.DataFrame({
            "document_name": [group["document_name"].iloc[0]],
            "run": [group["run"].iloc[0]],
            "leave": [leave.tolist()],
            "closed": [count.tolist()],
            "section": [_last(group["section"])],
            "page": [_last(group["page"])],
        })

    def chain_runs(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("run")
        state, rows = (0, 0, 1, None), []
        for row in group.itertuples():
            rows.append((row.document_name, row.run, *state))
            pending, no, page, section = state
            state = (
                row.leave[pending], no + row.closed[pending],
                _newer(row.page, page), _newer(row.section, section),
            )
        return pd.DataFrame(rows, columns=["document_name", "run", *_state_names()])

    def walk_run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        first = group.iloc[0]
        state = (first.entry_pending, first.entry_no, first.entry_page, first.entry_section)
        rows = []
        for row in group.itertuples():
            rows.append((row.document_name, row.block, *state))
            pending, no, page, section = state
            pending, closed = walk(pending, row.words, row.headers, size, overlap)
            state = (pending, no + closed, _newer(row.page, page), _newer(row.section, section))
        return pd.DataFrame(rows, columns=["document_name", "block", *_state_names()])

    tables = heads.groupBy("document_name", "run").applyInPandas(
        tabulate_run,
        "document_name string, run int, leave array<int>, closed array<int>, section string, page int",
    )
    starts = tables.groupBy("document_name").applyInPandas(
        chain_runs, f"document_name string, run int, {STATE}"
    )
    return (
        heads.join(starts, ["document_name", "run"])
        .groupBy("document_name", "run")
        .applyInPandas(walk_run, f"document_name string, block int, {STATE}")
    )


def _state_names():
    return [field.split()[0] for field in STATE.split(", ")]


def _newer(value, before):
    return before if pd.isna(value) else value


def _last(values: pd.Series):
    known = values.dropna()
    return known.iloc[-1] if len(known) else None
