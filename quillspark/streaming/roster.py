"""The rolling roster as a stream: chapters arrive in any order, the roster grows in reading order.

State is kept per book: the roster so far, the number of the next chapter, and chapters that
came too early. The stream's checkpoint is the resume point.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillspark.operators.roster import merge_duplicates, merge_rosters

OUTPUT = "book_id string, chapter_number int, names array<string>"
STATE = "next int, roster string, early string"


def chapter_entries(found: DataFrame) -> DataFrame:
    """(book_id, chapter_number, entries): the found characters of a chapter as one JSON list."""
    entry = F.struct("ord", "name", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), F.coalesce("pronunciation_hints", F.array().cast("array<string>")).alias("pronunciation_hints"))
    return found.groupBy("book_id", "chapter_number").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("entries"))


def _step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    nxt, roster, early = (state.get[0], json.loads(state.get[1]), json.loads(state.get[2])) if state.exists else (1, [], {})
    for pdf in frames:
        for n, entries in zip(pdf.chapter_number, pdf.entries):
            if int(n) >= nxt:  # a chapter that came again changes nothing
                early[str(int(n))] = json.loads(entries)
    out = []
    while str(nxt) in early:
        found = [e | {"first_appearance_chapter": nxt} for e in early.pop(str(nxt))]
        roster = merge_duplicates(merge_rosters(roster, found))
        out.append((key[0], nxt, [e["name"] for e in roster]))
        nxt += 1
    state.update((nxt, json.dumps(roster), json.dumps(early)))
    yield pd.DataFrame(out, columns=["book_id", "chapter_number", "names"])


def rolling_roster_stream(chapters: DataFrame) -> DataFrame:
    """``chapters`` streams (book_id, chapter_number, entries); out comes the roster's names after each chapter in turn."""
    return chapters.groupBy("book_id").applyInPandasWithState(_step, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
