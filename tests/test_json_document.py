"""A JSON document in byte ranges against json.loads."""

import json
import random

import pytest

from kardex.sources import json_document as jd
from kardex.sources.files import read_inventory_json


def odd_text(rng):
    return "".join(rng.choice(['a', '"', "\\", "{", "}", "[", "]", ":", ",", "é", "🎉", "\n", "\\\"", '":[{']) for _ in range(rng.randint(0, 12)))


def document(seed, n=60):
    rng = random.Random(seed)
    nested = lambda: {"x": odd_text(rng), "y": [{"z": odd_text(rng)}, [], {}], "k": {"deep": [1, odd_text(rng)]}}
    return {
        "tiendas_info": [{"tienda_id": f"T{i}", "ciudad": odd_text(rng), "extra": nested()} for i in range(n)],
        "nota \"}{": odd_text(rng), "vacio": [], "numero": -1.5e3,
        "catalogo": {"version": odd_text(rng), "productos": [{"sku_erp": f"E{i}", "nombre": odd_text(rng), "cost_history": [
            {"fecha_vigencia": "2025-01-01", "costo_mxn": str(j)} for j in range(i % 4)]} for i in range(n)], "fin": {"a": [1]}},
        "snapshots": [{"fecha": "2025-01-01", "tienda_id": odd_text(rng), "sku_erp": "\\" * i, "cantidad_en_stock": "3"} for i in range(n)]}


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("indent", [None, 1])
def test_ranges_by_brute_force(tmp_path, monkeypatch, seed, indent):
    """Tiny ranges and blocks: boundaries fall within strings, escapes, keys and code points."""
    rng = random.Random(seed)
    doc = document(seed, 12)
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(doc, indent=indent, ensure_ascii=seed % 2 == 0))
    monkeypatch.setattr(jd, "BLOCK_BYTES", rng.choice((3, 17, 64)))
    d = jd.Document(str(path))
    cut = jd.ranges(d, rng.choice((5, 23, 101)))
    in_string, depth, states, keys = False, 0, [], []
    for a, b in cut:
        states.append((in_string, depth))
        flips, out, inside = jd.summary(d, a, b)
        depth += inside if in_string else out
        in_string ^= flips
    assert not in_string and depth == 0
    for (a, b), s in zip(cut, states):
        keys += jd.outer_keys(d, jd.walk(d, a, b, *s))
    names = [json.loads(f'"{k}"') for _, _, k in sorted(keys)]
    assert names == ["tiendas_info", 'nota "}{', "vacio", "numero", "catalogo", "version", "productos", "fin", "snapshots"]
    at = {json.loads(f'"{k}"'): p for p, _, k in keys}
    for name, want, level, end in [("tiendas_info", doc["tiendas_info"], 2, at['nota "}{']), ("productos", doc["catalogo"]["productos"], 3, at["fin"]), ("snapshots", doc["snapshots"], 2, d.size)]:
        got = [e for (a, b), s in zip(cut, states) for e in jd.elements(d, a, b, *s, at[name], end, level)]
        assert [json.loads(t) for _, t in got] == want


def test_document_equals_the_one_task_reader(spark, tmp_path):
    rng = random.Random(3)
    doc = {"tiendas_info": [{"tienda_id": f"T{i}", "ciudad": odd_text(rng), "region": None, "timezone": "UTC"} for i in range(40)],
           "sku_mappings": [{"sku_pos": f"P{i}", "sku_erp": f"E{i}", "handle": None} for i in range(30)],
           "catalogo": {"productos": [{"sku_erp": f"E{i}", "nombre": odd_text(rng), "categoria": "c", "cost_history": [
               {"fecha_vigencia": f"2025-01-{j + 1:02d}", "costo_mxn": f"{j}.5", "proveedor": odd_text(rng)} for j in range(i % 5)]} for i in range(50)]},
           "snapshots": [{"fecha": "2025-02-01", "tienda_id": f"T{i % 7}", "sku_erp": f"E{i}", "cantidad_en_stock": rng.choice(["3.7", "junk", None, "12"])} for i in range(900)]}
    path = tmp_path / "inventory.json"
    path.write_text(json.dumps(doc))
    one, many = read_inventory_json(spark, str(path)), jd.read_inventory_document(spark, str(path), range_bytes=1000)
    for name in one:
        key = lambda r: repr(r)
        assert sorted(many[name].collect(), key=key) == sorted(one[name].collect(), key=key) and many[name].schema == one[name].schema, name
    assert many["snapshots"].rdd.getNumPartitions() > 20


def test_part_files_are_one_document(spark, tmp_path):
    rows = spark.createDataFrame([(i, f'q"{i}\\', None if i % 3 else [i, i + 1]) for i in range(500)], "id long, name string, list array<int>").repartition(4)
    few = spark.createDataFrame([("a",)], "k string")
    jd.write_document({"few": few, "outer.rows": rows, "outer.none": rows.limit(0), "last": few}, str(tmp_path / "doc"))
    doc = jd.JsonDocument(spark, str(tmp_path / "doc"), range_bytes=700)
    assert sorted(doc.rows("outer.rows", rows.schema).collect()) == sorted(rows.collect())
    assert [r["k"] for n in ("few", "last") for r in doc.rows(n, few.schema).collect()] == ["a", "a"]
    assert doc.rows("outer.none", rows.schema).collect() == [] == doc.rows("absent", rows.schema).collect()


@pytest.mark.parametrize("text,what", [('{"a": [{"b": "x}]}', "within a string"), ('{"a": [{"b": 1}]', "open brackets"), ("", "empty")])
def test_broken_documents_fail(spark, tmp_path, text, what):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(ValueError, match=what):
        jd.JsonDocument(spark, str(tmp_path / "d.json"))
