import datetime as dt
import json
from decimal import Decimal

from finlake.sources import payload
from tests.conftest import rows


def _doc(spark, obj):
    return spark.createDataFrame([(json.dumps(obj),)], "payload string")


def _mov(tipo, ids=(1, 0, 0), status=0, sub=9, when="2024-03-31T23:59:00", desp=11, rec=0):
    return {"uniqueId": f"u{tipo}-{status}", "despesaId": ids[0], "receitaId": ids[1],
            "transferenciaId": ids[2], "contaId": 1, "cartaoCreditoId": None, "tipoMovimentacao": tipo,
            "tipoDespesaId": desp, "tipoReceitaId": rec, "subcategoriaId": sub, "dataMovimentacao": when,
            "descricaoValidadoRepeticao": "d", "valor": 12.5, "status": status, "ignorada": False,
            "isMovimentacaoFixa": True}


def test_movements(spark):
    items = [_mov(t) for t in range(6)]
    items += [_mov(0, ids=(0, 0, 5)), _mov(1, ids=(3, 1, 1), status=1), _mov(2, ids=(0, None, None), status=-1),
              _mov(1, status=2, sub=None, desp=0, rec=22)]
    out = payload.movements(_doc(spark, {"movimentacoes": items})).collect()
    assert len(out) == 9                                   # tipo 5 dropped
    by = {(r["tipo"], r["unique_id"]): r for r in out}
    assert by[(0, "u0-0")]["valor"] == Decimal("-12.50") and by[(4, "u4-0")]["valor"] == Decimal("-12.50")
    assert by[(1, "u1-0")]["valor"] == Decimal("12.50") and by[(1, "u1-0")]["valor_abs"] == Decimal("12.50")
    assert by[(3, "u3-0")]["tipo_transacao_id"] == -1 and by[(3, "u3-0")]["tipo_transacao_filho_id"] == -1
    assert by[(0, "u0-0")]["data"] == dt.date(2024, 3, 31)
    ids = sorted(r["id"] for r in out if r["unique_id"] in ("u0-0",) and r["tipo"] == 0)
    assert 5 in [r["id"] for r in out] and 3 in [r["id"] for r in out] and 0 in [r["id"] for r in out]
    assert ids
    sit = {r["unique_id"]: r["situacao"] for r in out}
    assert sit["u1-1"] == "pendente" and sit["u2--1"] == "não informado" and sit["u1-2"] == "pendente"
    r = [x for x in out if x["unique_id"] == "u1-2"][0]
    assert r["tipo_transacao_filho_id"] == 0 and r["tipo_transacao_id"] == 22
    settled = payload.movements(_doc(spark, {"movimentacoes": items}), status=[0]).count()
    assert settled == 6


def test_categories_hierarchy(spark):
    income = _doc(spark, [{"id": 1, "tipoCategoriaPaiId": 0, "nome": "Salary", "arquivado": False}])
    expense = _doc(spark, [
        {"id": 10, "tipoCategoriaPaiId": 0, "nome": "Home", "arquivado": True},      # archived parent
        {"id": 11, "tipoCategoriaPaiId": 10, "nome": "Rent", "arquivado": False},    # active child
        {"id": 12, "tipoCategoriaPaiId": 10, "nome": "Old", "arquivado": True},      # archived child
        {"id": 13, "tipoCategoriaPaiId": None, "nome": "Root", "arquivado": False},  # root
    ])
    got = rows(payload.categories(income, expense))
    assert got == sorted([(1, None, "Salary", "Receitas"), (11, "Home", "Rent", "Despesas"),
                          (13, None, "Root", "Despesas"),
                          (-1, "Transferências", "Transferências", "Transferências"),
                          (-2, "Não encontrado", "Não encontrado", "Não encontrado")], key=repr)


def test_accounts_and_cards(spark):
    acc = _doc(spark, [{"id": 1, "name": "Bank. Main"}, {"id": 2, "name": "plain"},
                       {"id": 3, "name": "a.b."}, {"id": 4, "name": None}])
    assert rows(payload.accounts(acc)) == sorted([(1, "Main"), (2, "plain"), (3, ""), (4, None)], key=repr)
    cards = _doc(spark, [{"id": 7, "nome": "Visa", "extra": 1}])
    assert rows(payload.cards(cards)) == [(7, "Visa")]


def test_budgets(spark):
    doc = {"categories": [
        {"category": {"name": "Casa"}, "subCategories": [
            {"category": {"name": "Aluguel"}, "planned": 1000.0, "paidExpenses": 900.0, "pendingExpenses": 0},
            {"category": {"name": "Luz"}, "planned": 0.01, "paidExpenses": 50.0, "pendingExpenses": 10.0}]},
        {"category": {"name": "Vazio"}, "subCategories": []},
        {"category": {"id": "", "name": ""}, "planned": 0.0, "subCategories": []}]}
    df = spark.createDataFrame([(dt.date(2024, 5, 1), json.dumps(doc))], "data date, payload string")
    got = rows(payload.budgets(df))
    assert got == [(dt.date(2024, 5, 1), "Casa", "Aluguel", Decimal("1000.00"), Decimal("900.00"), Decimal("0.00")),
                   (dt.date(2024, 5, 1), "Casa", "Luz", Decimal("0.00"), Decimal("50.00"), Decimal("10.00"))]
