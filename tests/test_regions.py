"""Cards, panes and the records of page families, read off whole pages."""

import pytest

from snapquarry.operators import dom, regions


@pytest.fixture(scope="module")
def told(spark):
    def run(f, *htmls, titles=None):
        rows = [(i, h) if titles is None else (i, titles[i], h) for i, h in enumerate(htmls)]
        schema = "page_id long, html string" if titles is None else "page_id long, title string, html string"
        return f(spark.createDataFrame(rows, schema)).collect()
    return run


def test_marks(spark):
    html = '<div class="a" id="1">x<p>y</p><div class="a" id="2"><br>z<img class="a" id="3"></div></div><script>q</script>'
    mark = {"a": lambda t, attrs, classes: attrs["id"] if "a" in classes else None}
    got = {r.node_id: r for r in dom.marked_nodes(spark.createDataFrame([(7, html), (8, None), (9, "")], "page_id int, html string"), mark).collect()}
    at = lambda n: (got[n].a.node, got[n].a.top, got[n].a.value, got[n].a.outer)
    assert at(0) == (0, 0, "1", None) and at(3) == (0, 0, "1", None) and at(4) == (4, 0, "2", 0) and at(7) == (7, 0, "3", 4)
    assert got[0].text == "x y z" and got[4].text == "z" and got[0].last_id == 7 and got[5].parent_last == 7
    assert got[8].tag == "script" and got[9].own_text == "q" and got[9].a is None
    assert got[1].line != got[3].line and got[3].line != got[6].line
    kept = dom.marked_nodes(spark.createDataFrame([(7, html)], "page_id int, html string"), mark, {"a"}).collect()
    assert {r.node_id for r in kept} == set(range(8))


def test_deep_pages(spark):
    """Unclosed nested tags take room in proportion to their number."""
    html = "<div class='a'>" * 50_000 + "x"
    df = dom.marked_nodes(spark.createDataFrame([(1, html)], "page_id int, html string"), {"a": lambda t, attrs, classes: "" if "a" in classes else None})
    assert df.filter("a.top = 0 and last_id = 50000").count() == 50_001


ITEM = '<div class="card ui_item popupItem{}"><h5 class="card-title">T</h5>{}</div>'


def test_cards(told):
    page = (
        ITEM.format("", '<p data-modifier-id="1">Base <b>stat</b></p><div class="tierParent"><p data-modifier-id="2">Affix<i data-modifier-id="9">in</i></p></div><p data-modifier-id="8"> </p>')
        + ITEM.format(" previousItem", '<p data-modifier-id="3">old</p>')
        + '<div class="tab-pane fade" id="other">' + ITEM.format("", "related") + "</div>"
        + '<div class="tab-pane fade" id="x-cache-1">' + ITEM.format("", "cached") + "</div>"
        + '<div class="tab-pane active show" id="now">' + ITEM.format("", "now") + "</div>"
        + '<div class="tab-pane show" id="half">' + ITEM.format("", "show alone is not active") + "</div>"
        + '<div class="card"><div class="card-header" data-i18n="hyperlink|name|30001">C</div><p data-modifier-id="4">Corroded</p></div>'
        + '<div class="card"><span data-i18n="TextTable_GameFunc|value|Func_Tips_DropSource">D</span></div><div class="card">Corrosion and related drop</div>'
    )
    got = told(regions.cards, page, "", None)
    assert [r.kind for r in sorted(got, key=lambda r: r.node_id)] == ["current", "historical", "related", "historical", "current", "related", "corrosion", "drop_source", "other"]
    rows = sorted(told(regions.card_records, page), key=lambda r: (r.section_name, r.key))
    assert [(r.record_type, r.section_name, r.key, r.text, r.variant, r.source_locator.row_index) for r in rows] == [
        ("base_stat", "corrosion", "modifier:4", "Corroded", "Corroded", 0), ("base_stat", "current", "modifier:1", "Base stat", "Base stat", 0), ("affix", "current", "modifier:2", "Affix in", "Base stat", 1)]


def test_panes(told):
    row = '<tr data-modifier-id="{0}"{1}><td>{2}</td><td>{3}</td></tr>'
    page = (
        '<div class="tab-pane" id="Blade"><p data-modifier-id="0">before</p>' + ITEM.format("",
            '<p data-modifier-id="1">Stat <b>one</b></p><div data-block="detail">Special<br>way<hr>after</div>') + '<p data-modifier-id="2">outside the card, still current</p>'
        + ITEM.format(" previousItem", '<p data-modifier-id="3">old</p><div data-block="detail">old way<hr></div>') + ITEM.format("", '<p data-modifier-id="4">later</p>') + "</div>"
        + f'<div class="tab-pane" id="{regions.BASE_PANE}"><table><tr><th>Tier</th><th>Modifier</th></tr>' + row.format("b1", "", "1", "base") + row.format("", "", "2", "keyless") + "</table></div>"
        + f'<div class="tab-pane" id="{regions.CRAFT_PANE}"><table>' + row.format("c1", ' data-tier="0+"', "1", "craft") + '<tr><td>2</td><td><i data-modifier-id="c2" data-tier="9">inner</i></td></tr>' + "</table></div>"
        + f'<div class="tab-pane" id="{regions.LEGENDARY_PANE}"><p data-modifier-id="l1">Legend<i data-modifier-id="l2">ary</i></p></div><div class="tab-pane" id="Item"><p data-modifier-id="5">none</p></div>'
    )
    got = told(regions.pane_records, page, page, titles=["Blade", "Other"])
    key = lambda r: (r[0], r[1])
    mine = sorted(((r.record_type, r.key, r.text, r.tier, r.source_locator.row_index) for r in got if r.entity_id == "0"), key=key)
    assert [m[:2] for m in mine] == [("base_affix", "modifier:b1"), ("base_affix", "row:1"), ("base_stat", "modifier:1"), ("base_stat", "modifier:2"), ("craft_affix", "modifier:c1"),
        ("craft_affix", "modifier:c2"), ("legendary_affix", "modifier:l1"), ("special_mechanic", "section:special_mechanic")]
    assert [m[2] for m in mine] == ["base", "keyless", "Stat one", "outside the card, still current", "craft", "inner", "Legend ary", "Special way"]
    assert [m[3] for m in mine] == [None, None, None, None, "t0_plus", "all", None, None]
    assert {r.record_type for r in got if r.entity_id == "1"} == {"base_affix", "craft_affix", "legendary_affix"}  # no pane of that title


def test_recipes(told):
    page = (
        f'<div class="row"><div class="col"><div id="{regions.RECIPES}" class="active show"><div class="col"><div class="col">inner</div><p data-id="r1" data-modifier-id="11">Gain 1</p>核心天赋 Lv.2 <a href="Rose">Rose</a> x3 <a href="Ro">Ro</a> x12 <a href="No">No</a></div>'
        '<div class="col">no modifier <a href="Rose">Rose</a></div><div class="col"><i data-modifier-id="12">Gain</i><i data-modifier-id="13">more</i><a href="R.1">R.1</a> x 4</div></div></div></div>'
        '<div class="col"><p data-modifier-id="99">elsewhere</p></div>'
    )
    got = sorted(told(regions.recipe_cards, page), key=lambda r: r.source_locator.row_index)
    assert [(r.key, r.section_name, r.text, r.talent_type, r.recipe_id) for r in got] == [("modifier:11", "核心天赋", "Gain 1", "core", "r1"), ("modifier:12", regions.RECIPES, "Gain\nmore", None, None)]
    assert [(m.name, m.route, m.quantity) for m in got[0].materials] == [("Rose", "/cn/Rose/", 3), ("Ro", "/cn/Ro/", 12), ("No", "/cn/No/", None)]
    assert [m.quantity for m in got[1].materials] == [None]
    table = f'<div id="{regions.SEQUENCES}"><table class="DataTable"><tr><th>Affix</th><th>来源</th></tr><tr><td><p data-modifier-id="21">Tower</p></td><td>Sword</td><td data-chip="AB">高阶序列 AB</td></tr><tr><td>none</td></tr></table></div><table><tr><td data-modifier-id="7">x</td></tr></table>'
    got = told(regions.sequence_rows, table)
    assert [(r.key, r.text, r.section_name, r.sequence_tier, r.pattern, r.equipment) for r in got] == [("modifier:21", "Tower", "高阶序列 AB · Sword", "advanced", "AB", "Sword")]


def box(alt, body):
    return f'<div class="d-flex border-top"><img alt="{alt}"><div class="flex-grow-1">{body}</div></div>'


def test_traits(told):
    page = (
        box("early", '<b class="fw-bold">not in the card</b>') + '<div class="card"><h5 class="card-header">Rehan - Anger - 英雄特性 /3</h5>'
        + box("fire", '<div class="fw-bold">Blaze</div><div>需求等级 45</div><div><span>Burn <b>all</b></span><br>twice</div><hr><span>展开</span><p>Blaze</p><p>end</p>')
        + box("ice", '<div class="fw-bold">Frost</div>free text<div>需求等级 60</div><div class="tierParent"><span class="tierLevel">等级 1</span>free<div>slow <i>one</i></div><p>more</p><hr><p>behind the rule</p><span class="tierLevel">等级 2</span><div>freeze<hr>inside</div><span class="tierLevel">odd</span><div>lost</div></div><div>outside</div>')
        + box("fire", '<div class="fw-bold">Again</div><div>warm</div>') + box("none", "<div>no title</div>") + box("odd", '<div class="fw-bold">Odd</div><span class="tierLevel">n/a</span><div>lost</div>') + "</div>"
        + box("late", '<b class="fw-bold">behind the card</b>')
    )
    got = sorted(told(regions.trait_levels, page, "<p>no card</p>"), key=lambda r: r.source_locator.row_index)
    assert [(r.node_name, r.required_level, r.trait_level, r.key, r.text) for r in got] == [
        ("Blaze", 45, None, "asset:fire:occurrence:1:level:unspecified", "Burn all twice end"), ("Frost", 60, 1, "asset:ice:occurrence:1:level:1", "slow one more"),
        ("Frost", 60, 2, "asset:ice:occurrence:1:level:2", "freeze inside"), ("Again", None, None, "asset:fire:occurrence:2:level:unspecified", "warm"), ("Odd", None, None, "asset:odd:occurrence:1:level:unspecified", "")]


def test_skills(told):
    growth = '<table><tr><th>Tier</th><th>name</th></tr>{}</table>'
    page = (
        '<div class="tab-pane active show" id="s">' + ITEM.format("", '<span class="tag">Fire</span><span class="tag">Area</span><span class="tag">Fire</span><div data-block="weapon_restrict_description">Bows</div>'
        '<div class="d-flex justify-content-center"><span class="tag">Area</span></div><div class="d-flex justify-content-center">Cost 5</div><p class="explicitMod">Hits</p><p class="explicitMod">Hits</p><p class="explicitMod">Burns</p>') + "</div>"
        '<div class="tab-pane" id="cache-1">' + ITEM.format("", '<p class="explicitMod">cached</p><p data-modifier-id="9">cached</p>') + "</div>" + ITEM.format(" previousItem", '<p data-modifier-id="8">old</p>')
        + growth.format('<tr><td>1</td><td><i data-modifier-id="m1">one</i></td></tr><tr><td>2</td><td><i data-modifier-id="m2">two</i></td></tr><tr><td>3</td><td><i data-modifier-id="m2">three</i></td></tr>')
        + '<i data-modifier-id="m3">free</i><div class="card"><div class="card-header">Info</div><div>id: 77</div></div>'
    )
    two = ITEM.format("", "a") + ITEM.format("", "b")
    got = sorted(told(regions.skill_pages, page, two, "<p>none</p>"), key=lambda r: (r.record_type, r.source_locator.row_index))
    assert [(r.record_type, r.key, r.text, r.tier) for r in got] == [
        ("skill_effect", "skill:77", "T 标签：Fire、Area Bows Cost 5 Hits Burns", None), ("skill_growth", "modifier:m1", "one", "1"), ("skill_growth", "modifier:m2:tier:2", "two", "2"),
        ("skill_growth", "modifier:m2:tier:3", "three", "3"), ("skill_growth", "modifier:m3", "free", "unknown")]


@pytest.mark.parametrize("f", [regions.cards, regions.card_records, regions.recipe_cards, regions.sequence_rows, regions.trait_levels, regions.skill_pages])
def test_nothing(told, spark, f):
    assert told(f, None, "", "<p>plain</p>") == [] and f(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_one_exchange(spark):
    """Each operator deals a page's nodes once."""
    df = spark.createDataFrame([(1, "t", "<p>x</p>")], "page_id long, title string, html string")
    for f in (regions.cards, regions.card_records, regions.pane_records, regions.recipe_cards, regions.sequence_rows, regions.trait_levels, regions.skill_pages):
        plan = f(df)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= 2 and "Join" not in plan, (f, plan)
