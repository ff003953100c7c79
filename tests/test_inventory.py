"""Every item of the operator inventory names importable functions and
registered keys."""

import importlib

import __spark_entry__ as E
from groundtrack.plans.inventory import INVENTORY


def _resolve(path):
    mod, _, name = path.rpartition(".")
    return getattr(importlib.import_module(mod), name)


def test_every_item_is_implemented_and_registered():
    keys = set(E.queries())
    for item, (_, funcs, regs) in INVENTORY.items():
        for f in funcs:
            assert callable(_resolve(f)), (item, f)
        assert set(regs) <= keys, (item, set(regs) - keys)


def test_inventory_is_complete():
    want = ({f"S{i}" for i in range(1, 6)} | {f"K{i}" for i in range(1, 12)} | {f"P{i}" for i in range(1, 17)}
            | {f"J{i}" for i in range(1, 4)} | {f"A{i}" for i in range(1, 9)} | {f"W{i}" for i in range(1, 4)}
            | {f"L{i}" for i in range(1, 4)} | {f"F{i}" for i in range(1, 12)} | {f"T{i}" for i in range(1, 9)})
    assert set(INVENTORY) == want
