"""Invented raw series documents covering the cases of FIXTURES.md section 4."""

import json
import os

NAT = "Total Nacional"


def obs(year, fk=None, value=None, key="FK_Periodo"):
    d = {"Anyo": year, "Valor": value}
    if fk is not None:
        d[key] = fk
    return d


def series_by_code():
    return {
        50913: [  # CPI, monthly
            {"Nombre": f"{NAT}. Índice general. Índice.",
             "Data": [obs(2015, m, 100.0 + m) for m in range(1, 13)]
             + [obs(2016, 1, 110.0, key="Fk_Periodo"), obs(2016, 0, None) | {"Fk_Periodo": 2, "Valor": 111.0}]},
            {"Nombre": f"{NAT}. Índice general. Variación anual.", "Data": [obs(2015, 1, 1.5)]},
            {"Nombre": f"{NAT}. Índice general. Variación mensual.", "Data": [obs(2015, 1, 0.1)]},
            {"Nombre": f"{NAT}. Alimentos. Índice.", "Data": [obs(2015, 1, 99.0), obs(2015, 2, None)]},
            {"Nombre": "Andalucía. Índice general. Índice.", "Data": []},
            {"Nombre": "Too short", "Data": [obs(2015, 1, 5.0)]},
        ],
        25171: [  # HPI, quarterly
            {"Nombre": f"{NAT}. General. Índice.", "Data": [obs(2015, q, 90.0 + q) for q in (19, 20, 21, 22)]},
            {"Nombre": f"{NAT}. Vivienda nueva. Índice.", "Data": [obs(2015, 19, 80.0)]},
        ],
        65334: [  # unemployment rate
            {"Nombre": f"Tasa de paro de la población. Ambos sexos. Andalucía. Todas las edades.",
             "Data": [obs(2015, 19, 30.0), obs(2015, 20, 28.0), obs(2015, 21, None)]},
            {"Nombre": f"Tasa de paro de la población. Ambos sexos. {NAT}. Todas las edades.",
             "Data": [obs(2015, 19, 22.0), obs(2015, 99, 1.0)]},
        ],
        65132: [  # employees by contract
            {"Nombre": f"{NAT}. Asalariados. Ambos sexos. Total asalariados. Jornada Total. Personas.",
             "Data": [obs(2015, 19, 1000.0), obs(2015, 20, 1100.0)]},
            {"Nombre": f"{NAT}. Asalariados. Ambos sexos. Asalariados con contrato temporal. Jornada Total. Personas.",
             "Data": [obs(2015, 19, 250.0), obs(2015, 20, 275.0)]},
            {"Nombre": f"{NAT}. Asalariados. Ambos sexos. Total asalariados. Jornada a tiempo parcial. Personas.",
             "Data": [obs(2015, 19, 10.0)]},
            {"Nombre": f"{NAT}. Asalariados. Ambos sexos. Otro contrato. Jornada Total. Personas.",
             "Data": [obs(2015, 19, 10.0)]},
        ],
        28186: [  # wages by occupation
            {"Nombre": f"Directores. Mujeres. Salario medio bruto. {NAT}. Dato base.", "Data": [obs(2015, 28, 50000.0)]},
            {"Nombre": f"Directores. Hombres. Salario medio bruto. {NAT}. Dato base.", "Data": [obs(2015, 28, 60000.0)]},
            # dropped parts make a duplicate key: first in order wins
            {"Nombre": f"Directores. Hombres. Otro. {NAT}. Otro.", "Data": [obs(2015, 28, 1.0)]},
        ],
        28191: [  # wage percentiles
            {"Nombre": f"Total. {NAT}. Dato base. Media.", "Data": [obs(2015, 28, 25000.0), obs(2016, 28, 26000.0)]},
            {"Nombre": f"Total. {NAT}. Dato base. \t50 .", "Data": [obs(2015, 28, 21000.0)]},
            {"Nombre": f"Total. {NAT}. Dato base. 75.", "Data": [obs(2015, 28, 30000.0)]},
            {"Nombre": f"Mujeres. Andalucía. Dato base. Media.", "Data": [obs(2015, 28, 20000.0)]},
            {"Nombre": f"Hombres. Andalucía. Dato base. Media.", "Data": [obs(2015, 28, 24000.0)]},
        ],
        6061: [  # labour cost
            {"Nombre": f"{NAT}. Industria. Coste salarial total. Costes laborales. Euros.",
             "Data": [obs(2015, 19, 2000.0), obs(2015, 20, 2100.0)]},
            {"Nombre": f"{NAT}. Industria. Otros costes. Costes laborales. Euros.", "Data": [obs(2015, 19, 500.0)]},
        ],
        99999: [{"Nombre": "Unknown. Table. X.", "Data": [obs(2015, 28, 1.0)]}],
    }


def write_lines(folder, docs=None):
    """JSON Lines landing form (table_code, series_pos added)."""
    docs = docs or series_by_code()
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "batch.json"), "w", encoding="utf-8") as fh:
        for code, series in docs.items():
            for pos, s in enumerate(series):
                fh.write(json.dumps({"table_code": code, "series_pos": pos, **s}, ensure_ascii=False) + "\n")
    return folder


def write_files(folder, docs=None):
    """Downloaded form: <code>.json with an array (or a lone object)."""
    docs = docs or series_by_code()
    os.makedirs(folder, exist_ok=True)
    for code, series in docs.items():
        payload = series[0] if len(series) == 1 else series
        with open(os.path.join(folder, f"{code}.json"), "w", encoding="utf-8") as fh:
            json.dump(payload, fh, ensure_ascii=False, indent=1)
    return folder


def extra_cases():
    """More FIXTURES.md section-4 cases, kept apart from the base batch."""
    return {
        28191: [
            {"Nombre": "Total. Murcia. Dato base. Media."},  # no Data at all
            {"Nombre": f"Total. {NAT}. Dato base. 25.", "Data": [obs(2017, None, 18000.0)]},  # no period code
            {"Nombre": f"Total.\u00a0{NAT}\u00a0. \t. Dato base. 10.", "Data": [obs(2017, 28, 9000.0)]},  # NBSP, blank part
            {"Nombre": f"Total. {NAT}. Dato base. Media.", "Data": [obs(2018, 28, None)]},  # NULL wage
        ],
        28186: [
            {"Nombre": f"Técnicos. Mujeres. Salario medio bruto. {NAT}. Dato base.", "Data": [obs(2015, 28, 30000.0)]},
            {"Nombre": f"Operarios. Mujeres. Salario medio bruto. {NAT}. Dato base.", "Data": [obs(2015, 28, 20000.0)]},
            {"Nombre": f"Operarios. Hombres. Salario medio bruto. {NAT}. Dato base.", "Data": [obs(2015, 28, 0.0)]},
        ],
    }
