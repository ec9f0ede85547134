"""Every SURVEY §2 inventory id has a registered query, but for M20 (see README)."""

import __spark_entry__ as entry

IDS = ([f"s{i}" for i in range(1, 9)] + [f"p{i}" for i in range(1, 25)] + [f"t{i:02d}" for i in range(1, 27)]
       + [f"l{i}" for i in range(1, 5)] + [f"u{i}" for i in range(1, 4)] + [f"j{i}" for i in range(1, 4)]
       + [f"a{i}" for i in range(1, 11)] + [f"m{i}" for i in range(1, 36) if i != 20]
       + [f"k{i}" for i in range(1, 9)])


def test_every_inventory_id_is_registered():
    names = list(entry.queries())
    missing = [i for i in IDS if not any(n.startswith(i + "_") for n in names)]
    assert missing == []
