"""Fixed values.

These literals must equal the source system's for the marts to mean the same
thing; they are stated here once, in natural order, and every operator takes
them as overridable parameters.
"""

# --- fixed values (must match the source system) -------------------------------
NATURE_INCOME = "Receitas"
NATURE_EXPENSE = "Despesas"
NATURE_TRANSFER = "Transferências"
NATURE_NOT_FOUND = "Não encontrado"

STATUS_SETTLED = "efetivado"
STATUS_PENDING = "pendente"
STATUS_UNKNOWN = "não informado"

GROUP_INCOME = "Rendimentos"
GROUP_LIFESTYLE = "Estilo de Vida"
LIFESTYLE_PARENTS = ["Habitação", "Saúde", "Educação", "Transporte", "Outros fixos"]

SALARY_SUBCATEGORY = "Salario"
INSTALMENT_SUBCATEGORY = "Parcelados"

INSTALMENT_PATTERN = r"\((\d+)/(\d+)\)"
INTEREST_RATE = "0.0035"          # daily projected interest on a negative balance
BUDGET_PLACEHOLDER = "0.01"       # planned amount meaning "no budget"

SENTINEL_CATEGORIES = [
    # (id, parent id, name, nature)
    (-1, -1, "Transferências", "Transferências"),
    (-2, -2, "Não encontrado", "Não encontrado"),
]

MOVEMENT_TYPES = [0, 1, 2, 3, 4]      # kept movement types (tipoMovimentacao < 5)
NEGATIVE_TYPES = [0, 4]               # movement types whose amount is an outflow
TRANSFER_MIN_TYPE = 3                 # tipo >= 3 -> transfer, category -1
TRAILING_SHORT = (4, 3)               # "3-month mean": sums 4 prior rows, divides by 3
TRAILING_LONG = (7, 6)                # "6-month mean": sums 7 prior rows, divides by 6
# -------------------------------------------------------------------------------

MONEY = "decimal(18,2)"       # row-level amounts
MONEY_TOTAL = "decimal(38,2)"  # aggregated amounts (no overflow at any scale)
