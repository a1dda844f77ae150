"""Main body and residue of pages in one reading: residue is judged without furniture, furniture without residue."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidemark.llm.furniture import pages_with_paths, winners
from tidemark.llm.residue import Values, fit, residue_values


def template_residue(articles: DataFrame) -> DataFrame:
    """article_id, field_name of values with residue instead of what belongs there."""
    return residue_values(articles)


def main_body_lines(articles: DataFrame) -> DataFrame:
    """article_id, line_no (from 1) of lines that are not main body; pages whose content is residue are left out.

    Lines of null or blank content: none. Repeated rows give their lines each.
    """
    won, each = winners(articles)
    models = fit(articles, won, each)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = Values(pdf.assign(error_message=None), won)
            ids, nos = [], []
            for i, case in enumerate(values.residue(models)):
                if not case:
                    at = np.flatnonzero(values.marks[i])
                    ids.append(np.full(len(at), values.ids[i], np.int64))
                    nos.append(at + 1)
            yield pd.DataFrame({"article_id": np.concatenate(ids) if ids else np.empty(0, np.int64), "line_no": np.concatenate(nos) if nos else np.empty(0, np.int64)})

    return pages_with_paths(articles, each).mapInPandas(run, "article_id bigint, line_no bigint")
