import json
import os

from finlake.__main__ import main
from finlake.session import local_path


def _lines(path, docs):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "part-0.json"), "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def test_cli_extract_then_pipeline(spark, scratch):
    pages, raw, lake = f"{scratch}/pages", f"{scratch}/raw", f"{scratch}/lake"
    _lines(f"{pages}/cards", [[{"id": 1, "nome": "Visa"}]])
    _lines(f"{pages}/accounts", [[{"id": 7, "name": "Banco. Corrente"}]])
    _lines(f"{pages}/income_categories", [[{"id": 1, "tipoCategoriaPaiId": 0, "nome": "Rendimentos", "arquivado": False},
                                           {"id": 2, "tipoCategoriaPaiId": 1, "nome": "Salario", "arquivado": False}]])
    _lines(f"{pages}/expense_categories", [[{"id": 10, "tipoCategoriaPaiId": 0, "nome": "Habitação", "arquivado": False},
                                            {"id": 11, "tipoCategoriaPaiId": 10, "nome": "Aluguel", "arquivado": False}]])
    mov = lambda uid, tipo, v, sub, st: {
        "uniqueId": uid, "despesaId": 5 if tipo == 0 else 0, "receitaId": 6 if tipo == 1 else None,
        "transferenciaId": None, "contaId": 7, "cartaoCreditoId": 1 if tipo == 0 else None,
        "tipoMovimentacao": tipo, "tipoDespesaId": 10 if tipo == 0 else 0, "tipoReceitaId": 1 if tipo == 1 else 0,
        "subcategoriaId": sub, "dataMovimentacao": "2024-02-05T10:00:00", "descricaoValidadoRepeticao": "x (1/3)",
        "valor": v, "status": st, "ignorada": False, "isMovimentacaoFixa": False}
    _lines(f"{pages}/movements", [{"movimentacoes": [mov("a", 0, 1500.0, 11, 0), mov("b", 1, 5000.0, 2, 0),
                                                     mov("c", 0, 80.0, 11, 1)]}])
    _lines(f"{pages}/budgets", [{"data": "2024-02-01", "categories": [
        {"category": {"name": "Habitação"}, "subCategories": [
            {"category": {"name": "Aluguel"}, "planned": 1600.0, "paidExpenses": 1500.0, "pendingExpenses": 80.0}]}]}])
    main(["extract", "--pages", pages, "--raw", raw, "--refdate", "2024-03-10",
          "--extraction-ts", "20240310_080000"])
    main(["pipeline", "--raw", raw, "--lake", lake, "--run-date", "2024-03-10", "--version", "1",
          "--clean-source", "archive"])
    from finlake.plans.lake import Lake
    k = Lake(spark, lake).read_state("analytics", "main_kpis").where("ano_mes = '2024-02-01'").first()
    assert float(k["total_salario"]) == 5000.0
    assert float(k["total_receitas"]) == 5000.0 and float(k["total_despesas"]) == 1580.0
    assert abs(k["prc_estilo_de_vida"] - 1580.0 / 5000.0) < 1e-9
