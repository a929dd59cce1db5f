"""The card market on literal feed records, from feed to mart."""

import datetime as dt
import json

import pytest

from lakemart.domain.cards import gold, jobs, stage
from lakemart.domain.cards import schemas as sc
from lakemart.operators.quality import DataQualityError
from lakemart.plans.runlog import AUDIT_TABLE
from lakemart.plans.store import TableStore
from lakemart.sources.json_source import scan_jsonl

RUN1 = dt.datetime(2026, 9, 5, 10)
RUN2 = dt.datetime(2026, 10, 5, 10)

RAW = {"cards": sc.RAW_CARD, "sets": sc.RAW_SET, "card_prices": sc.RAW_CARD,
       "rulings": sc.RAW_RULING, "migrations": sc.RAW_MIGRATION}


def card(id="c1", **others):
    base = {
        "id": id, "oracle_id": "o1", "name": "Árvore Mãe", "mana_cost": "{2}{U}{U}", "cmc": 4,
        "colors": ["U"], "color_identity": ["U", "W"], "type_line": "Creature — Moss Tinker",
        "rarity": "rare", "set": "qmv", "set_name": "trial set", "oracle_text": "({T}: Add {G}.)",
        "artist": "jo silva", "collector_number": "7", "layout": "normal", "released_at": "2024-05-01",
        "image_uris": {"normal": "http://img/1"}, "legalities": {"standard": "legal", "modern": "not_legal"},
        "prices": {"usd": "1.35", "eur": "n/a"}, "scryfall_uri": "http://card/1",
    }
    return {k: v for k, v in (base | others).items() if v is not ...}


@pytest.fixture
def feed(spark, tmp_path):
    def make(name, records, suffix=""):
        path = tmp_path / f"{name}{suffix}.jsonl"
        path.write_text("\n\n".join(json.dumps(r) for r in records))
        return scan_jsonl(spark, str(path), RAW[name])

    return make


def first(df):
    return df.first().asDict()


FACE = {"mana_cost": "{U}", "colors": ["R"], "type_line": "Land", "oracle_id": "o9", "power": "2",
        "image_uris": {"normal": "http://front"}}


def test_root_or_first_face(feed):
    two_faced = card(mana_cost=..., colors=[], oracle_id=..., image_uris=..., card_faces=[FACE, {"mana_cost": "x"}])
    row = first(stage.cards(feed("cards", [two_faced])))
    assert row["manaCost"] == "{U}" and row["oracle_id"] == "o9" and row["imageUrl"] == "http://front"
    assert row["colors"] == "[]" and row["type"] == "Creature — Moss Tinker" and row["power"] == "2"
    assert row["colorIdentity"] == '["U", "W"]' and row["cmc"] == 4.0
    assert json.loads(row["legalities"]) == {"standard": "legal", "modern": "not_legal"}
    assert row["types"] is None and row["multiverseid"] is None and row["printings"] is None
    plain = first(stage.cards(feed("cards", [card(mana_cost=..., card_faces=[])], "2")))
    assert plain["manaCost"] is None


def test_price_rows_and_images(feed):
    records = [card("p1", prices={"usd": "73.85"}), card("p2", image_uris={}, card_faces=[FACE], prices=...)]
    one, two = stage.card_prices(feed("card_prices", records)).orderBy("id").collect()
    assert (one.usd, one.usd_foil, one.image_url) == ("73.85", None, "http://img/1")
    assert (two.usd, two.image_url, two.releaseDate) == (None, "http://front", "2024-05-01")


def test_sets_and_migrations(feed):
    raw = feed("sets", [{"code": "qmv", "name": "n", "digital": False, "card_count": "many"},
                        {"code": "b", "digital": True, "card_count": 12, "set_type": "core"}])
    bad, good = stage.sets(raw).orderBy("name", ascending=False).collect()
    assert (bad.onlineOnly, bad.card_count, bad.booster_19) == (False, None, None)
    assert (good.onlineOnly, good.card_count, good.type, good.parent_set_code) == (True, 12, "core", None)
    raw = feed("migrations", [{"id": "m1", "metadata": {"id": "x", "set_code": "qmv"}}, {"id": "m2"}])
    with_meta, without = stage.migrations(raw).orderBy("id").collect()
    assert (with_meta.metadata_id, with_meta.metadata_set_code) == ("x", "qmv")
    assert without.metadata_id is None and without.new_scryfall_id is None


@pytest.fixture
def lake(spark, tmp_path, feed):
    class Lake:
        bronze, silver, gold = (TableStore(spark, str(tmp_path / n)) for n in ("bronze", "silver", "gold"))
        stage_root = str(tmp_path / "stage")

        def load(self, run_ts, feeds):
            raw_sets = feed("sets", feeds["sets"], f"-{run_ts:%m}")
            for name, records in feeds.items():
                raw = feed(name, records, f"-{run_ts:%m}")
                jobs.run_stage(raw, name, self.bronze, self.stage_root, run_ts, raw_sets=raw_sets)
                jobs.run_bronze(self.bronze, self.stage_root, name, run_ts)
            for table in jobs.TABLES:
                jobs.run_silver(self.bronze, self.silver, table, run_ts.date())

    return Lake()


def feeds():
    return {
        "cards": [card(), card("c2", oracle_id="o2", set="old", name="Dropped"),
                  card("c3", oracle_id="o3", colors=["W", "U"], type_line="Legendary Planeswalker — Jace", power="*")],
        "sets": [{"code": "QMV", "name": "trial set", "released_at": "2024-05-01", "set_type": "core", "block": "água"},
                 {"code": "old", "name": "Old", "released_at": "1990-01-01"}],
        "card_prices": [card(), card("c3", prices={"usd": "2.5", "tix": ""}), card("token", prices={"usd": "9"}),
                        card("ancient", released_at="1995-01-01")],
        "rulings": [{"oracle_id": "o1", "source": "wotc", "published_at": "2024-06-01", "comment": " Tap (it) for {G}. "},
                    {"oracle_id": "o1", "source": "scryfall", "published_at": "2024-07-01", "comment": "x"}],
        "migrations": [{"id": "m1", "performed_at": "2024-01-01", "migration_strategy": "merge",
                        "old_scryfall_id": "c1", "new_scryfall_id": "n1", "note": "{moved} (twice)"},
                       {"id": "m2", "performed_at": "2024-02-01", "migration_strategy": "merge",
                        "old_scryfall_id": "n1", "new_scryfall_id": "n2"},
                       {"id": "m3", "performed_at": "2024-03-01", "migration_strategy": "delete", "old_scryfall_id": "z"}],
    }


def test_two_monthly_runs(lake):
    lake.load(RUN1, feeds())
    cards = {r.ID_CARTA: r for r in lake.silver.read("TB_FATO_CARTAS").collect()}
    assert set(cards) == {"c1", "c3"}
    one, jace = cards["c1"], cards["c3"]
    assert (one.NME_CARTA, one.NME_TIPO_CARTA, one.DESC_DETALHE_TIPO_CARTA) == ("Arvore_Mae", "Creature", "Moss_Tinker")
    assert (one.DESC_CUSTO_MANA, one.QTD_CORES, one.COD_CORES, one.NME_CATEGORIA_COR) == ("[2][U][U]", 2, "U", "Mono")
    assert (one.DESC_CARTA, one.COD_IDENTIDADE_COR, one.COD_COLECAO) == ("[[Tap]: Add [Green].]", "U, W", "QMV")
    assert one.DESC_LEGALIDADES == '["standard": "legal", "modern": "not_legal"]'
    assert (one.DESC_TIPOS, one.DESC_SUBTIPOS, one.NME_FORCA) == ("NA", "NA", "0")
    assert (jace.NME_TIPO_CARTA, jace.NME_CATEGORIA_COR, jace.NME_FORCA) == ("Planeswalker", "Dual_Color", "*")
    assert (one.ANO_INGESTAO, one.MES_INGESTAO, one.NME_FONTE) == (2026, 9, "scryfall")

    prices = {r.ID_CARTA: r for r in lake.silver.read("TB_FATO_PRECOS_CARTAS").collect()}
    assert set(prices) == {"c1", "c3", "token"}
    assert prices["c1"].VLR_EUR is None and prices["c3"].VLR_TIX is None and prices["c3"].VLR_USD == 2.5

    rulings = lake.silver.read("TB_FATO_ESCLARECIMENTOS_CARTAS").orderBy("DT_PUBLICACAO").collect()
    assert [r.NME_EMISSOR for r in rulings] == ["Wizards", "Scryfall"]
    assert rulings[0].DESC_ESCLARECIMENTO == "Tap [it] for [G]."

    moves = {r.ID_MIGRACAO: r for r in lake.silver.read("TB_MOV_MIGRACOES_CARTAS").collect()}
    assert {k: m.ID_CARTA_CANONICO for k, m in moves.items()} == {"m1": "n2", "m2": "n2", "m3": "z"}
    assert (moves["m1"].DESC_NOTA, moves["m2"].DESC_NOTA) == ("[moved] [twice]", "NA")

    audit = jobs.run_gold(lake.silver, lake.gold)
    assert audit.processed == 2 and audit.results["precos_excluidos_sem_carta"] == 1
    fact = {r.ID_CARTA: r for r in lake.gold.read(gold.MART.fact_table).collect()}
    assert (fact["c1"].NME_COLECAO, fact["c1"].NME_BLOCO) == ("Trial_Set", "Agua")
    assert (fact["c1"].QTD_ESCLARECIMENTOS, fact["c1"].DT_ULTIMO_ESCLARECIMENTO) == (2, dt.date(2024, 7, 1))
    assert (fact["c1"].ID_CARTA_CANONICO, fact["c1"].FLG_ID_CARTA_MIGRADO) == ("n2", "Sim")
    assert (fact["c3"].QTD_ESCLARECIMENTOS, fact["c3"].DT_ULTIMO_ESCLARECIMENTO) == (0, dt.date(1001, 1, 1))
    assert (fact["c3"].ID_CARTA_CANONICO, fact["c3"].FLG_ID_CARTA_MIGRADO) == ("c3", "Nao")
    assert fact["c1"].asDict().keys() == set(sc.FACT)

    later = feeds()
    later["rulings"].append({"oracle_id": "o3", "source": "wotc", "published_at": "2026-09-20", "comment": "new"})
    lake.load(RUN2, later)
    assert lake.silver.read("TB_FATO_CARTAS").count() == 2
    assert lake.silver.read("TB_FATO_PRECOS_CARTAS").count() == 6
    jobs.run_gold(lake.silver, lake.gold)
    fact = lake.gold.read(gold.MART.fact_table)
    assert fact.count() == 4
    assert [r.QTD_ESCLARECIMENTOS for r in fact.filter("ID_CARTA = 'c3'").collect()] == [1, 1]
    assert lake.gold.read(AUDIT_TABLE).filter("DESC_STATUS = 'SUCESSO'").count() == 2


def test_failed_check_is_audited(lake):
    bad = feeds()
    bad["card_prices"] = [card(prices={"usd": "-1"})]
    lake.load(RUN1, bad)
    with pytest.raises(DataQualityError, match="valor_negativo_preco=1"):
        jobs.run_gold(lake.silver, lake.gold)
    row = lake.gold.read(AUDIT_TABLE).first()
    assert row.DESC_STATUS == "FALHA_DQ" and "valor_negativo_preco=1" in row.DESC_DQ_RESULTADO
    assert "cartas_excluidas_sem_cotacao_de_preco=1" in row.DESC_DQ_RESULTADO
