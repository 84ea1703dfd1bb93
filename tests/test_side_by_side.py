"""Independent trainings run side by side, and a gathered task holds narrow codes."""

from dataclasses import replace
from threading import Barrier
from types import SimpleNamespace

import numpy as np
import pytest

from riskloom.config import ROW_MODEL, CreditConfig
from riskloom.operators import boosting as B
from riskloom.plans import assembly, ensemble
from riskloom.session import together


def test_row_models_of_all_tables_train_at_once(spark, monkeypatch):
    block, all_there = spark.range(3), Barrier(3, timeout=20)
    for name in ("bureau", "previous", "pos", "card", "installment"):
        monkeypatch.setattr(assembly.children, f"{name}_features", lambda *_: block)
    monkeypatch.setattr(assembly, "materialize", lambda df, _: df)
    monkeypatch.setattr(assembly, "row_model_features", lambda rows, *args: all_there.wait() * 0 or (block, args[3]))
    names = ("bureau", "bureau_balance", "previous_application", "POS_CASH_balance", "credit_card_balance", "installments_payments")
    blocks, aucs = assembly.feature_blocks(dict.fromkeys(names, block), block, CreditConfig())
    assert len(blocks) == 8 and aucs == {"PREV_SUB": "PREV", "BURO_SUB": "BURO", "INS_SUB": "INS"}
    assert list(aucs) == ["PREV_SUB", "BURO_SUB", "INS_SUB"]


def test_numeric_and_categorical_models_train_at_once(spark, monkeypatch):
    both = Barrier(2, timeout=20)
    tables = {"numeric": spark.createDataFrame([(1, 0.5)], "SK_ID_CURR int, a double"), "categorical": spark.createDataFrame([(1, 0.25)], "SK_ID_CURR int, b double")}
    monkeypatch.setattr(ensemble, "_groups", lambda *_: [(n, t, ["preset"], []) for n, t in tables.items()])
    monkeypatch.setattr(ensemble, "oof_scores", lambda rows, *_: both.wait() * 0 or rows)
    store = SimpleNamespace(spark=spark, predictions=lambda name, compute: compute())
    assert ensemble.model_scores(None, CreditConfig(), store).collect() == [(1, 0.5, 0.25)]


def test_an_error_of_one_call_is_raised(spark):
    with pytest.raises(ZeroDivisionError):
        together(spark, [lambda: 1, lambda: 1 / 0])
    assert together(spark, [lambda: 1, lambda: 2]) == [1, 2]


def test_narrow_codes_give_the_same_trees():
    rng = np.random.default_rng(3)
    widths = np.array([256, 256, 9])
    assert B._narrow(widths) is np.uint8 and B._narrow(np.append(widths, 257)) is np.uint16
    codes = np.stack([rng.integers(0, w, 900) for w in widths], axis=1)
    label, held, rid = (codes[:, 0] > 99).astype(float), rng.random(900) < 0.2, rng.integers(0, 1 << 62, 900).astype(np.uint64)
    spec = B.Spec(replace(ROW_MODEL, max_iter=9, min_rows=5, feature_share=1.0), 1, (0, 1, 2))
    one, two = (B.fit_rows(spec, codes.astype(t), label, held, rid, widths) for t in (np.uint8, np.uint16))
    assert one.rows(0) == two.rows(0) and max(max(t.cut) for t in one.trees) > 64
