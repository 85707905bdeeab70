"""The judge is fitted on every labelled document."""

import numpy as np
import pyarrow as pa

from histdim.llm.quality import (ForestParams, IsolationForest, base_failed, calibrated, features, fitted_judge, labelled_features,
                                 statistics, telling)
from histdim.llm.words import utf8
from tests.llm.test_quality import labelled


def test_no_labelled_row_is_left_out(spark):
    assert not hasattr(ForestParams(), "fit_rows")
    d, labels, bad = labelled(spark)
    rows = labelled_features(d.repartition(5), labels.unionByName(labels), "doc_id", "text", "quality")
    assert rows.filter("good").count() == sum(not b for b in bad[:200]) and rows.filter("not good").count() == sum(bad[:200])
    judge = fitted_judge(d.repartition(5), labels)
    texts = [r.text for r in d.orderBy("doc_id").collect()][:200]
    stats, good = statistics(*utf8(pa.array(texts))), ~np.array(bad[:200])
    assert not base_failed(stats["n_words"], stats["n_repeat_words"]).any()
    p, shares = ForestParams(), features(stats)
    columns = telling(shares, good, p.least_auc, p.by_chance)
    own = IsolationForest(shares[good][:, columns], shares[:, columns], p)      # counted in memory
    assert columns.tolist() == judge.columns.tolist()
    assert all((getattr(own, k) == getattr(judge.forest, k)).all() for k in ("feature", "cut", "left", "length"))
    assert judge.threshold == calibrated(own.scores(shares[:, columns]), good, p.most_lost)


def test_counts_of_a_forest_are_those_of_its_rows():
    rnd = np.random.default_rng(3)
    good = np.rint(rnd.normal(0, 200, (3000, 2))) / 1024
    f = IsolationForest(good, good, ForestParams(trees=7))
    assert f.ends(good).sum() == 7 * 3000
    inner = f.feature >= 0
    assert (f.ends(good)[inner] == 0).all() and (f.length[~inner] > 0).all()
