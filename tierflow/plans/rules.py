"""Decision rules, code lists and limits of the banking data product."""

from __future__ import annotations

from tierflow.functions.ladders import Ladder

# Customer risk class, first match wins.
RISK = Ladder.from_text("""
RIESGO_CRITICO: {level} in ('04', '05') and {score} < 500 and {arrears} = 'SI'
RIESGO_ALTO: {level} in ('03', '04', '05') and {score} < 600 and {arrears} = 'SI'
RIESGO_MEDIO: {level} in ('03', '04', '05') or ({score} < 650 and {arrears} = 'SI')
RIESGO_BAJO: {level} = '02' or {score} < 700
SIN_RIESGO
""")

# Balance class, first match wins.
BALANCE = Ladder.from_text("""
SALDO_PREMIUM: {available} >= 200000 and {limit} >= 100000 and {segment} = 'VIP'
SALDO_ALTO: {available} >= 100000 and {limit} >= 50000 and {segment} in ('VIP', 'PREM')
SALDO_MEDIO: {available} >= 25000 and {limit} >= 10000
SALDO_BAJO: {available} >= 5000 or ({limit} >= 5000 and {segment} in ('STD', 'BAS'))
SALDO_CRITICO
""")

# Activity class by days since the last transaction, first match wins.
ACTIVITY = Ladder.from_text("""
CLIENTE_INTEGRAL: {days} <= 30 and {products} >= 8 and {state} = 'AC'
ACTIVIDAD_ALTA: {days} <= 90 and {products} >= 5 and {state} = 'AC'
ACTIVIDAD_MEDIA: {days} <= 180 and {products} >= 3 and {state} = 'AC'
ACTIVIDAD_BAJA: {days} <= 365 and {products} >= 1 and {state} in ('AC', 'IN')
INACTIVO
""")

# Transaction code, description, channel, least and greatest amount.
TRANSACTION_CODES = {
    "CATM": ("Credito por ATM", "ATM", 10, 1000),
    "DATM": ("Debito por ATM", "ATM", 10, 1000),
    "CMPR": ("Compra POS", "POS", 5, 15000),
    "TINT": ("Transferencia Interna", "WEB", 50, 50000),
    "DPST": ("Deposito en Sucursal", "SUC", 50, 100000),
    "PGSL": ("Pago al Saldo", "WEB", 100, 25000),
    "TEXT": ("Transferencia Externa", "WEB", 50, 50000),
    "RTRO": ("Retiro en Sucursal", "SUC", 50, 100000),
    "PGSV": ("Pago de Servicios", "WEB", 10, 5000),
    "NMNA": ("Deposito de Nomina", "ACH", 1000, 15000),
    "INTR": ("Interes Generado", "SYS", 1, 5000),
    "ADSL": ("Adelanto Salarial", "WEB", 500, 10000),
    "IMPT": ("Impuesto Retenido", "SYS", 1, 2000),
    "DMCL": ("Domiciliacion", "ACH", 20, 3000),
    "CMSN": ("Comision Bancaria", "SYS", 1, 500),
}

# Frequency bands of the transaction codes and their share in percent.
BANDS = {
    "ALTA": ["CATM", "DATM", "CMPR", "TINT", "DPST"],
    "MEDIA": ["PGSL", "TEXT", "RTRO", "PGSV", "NMNA", "INTR"],
    "BAJA": ["ADSL", "IMPT", "DMCL", "CMSN"],
}
BAND_SHARE = {"ALTA": 60.0, "MEDIA": 30.0, "BAJA": 10.0}

# Account type, name, weight, least and greatest available balance.
ACCOUNT_TYPES = {
    "AHRO": ("Cuenta de Ahorro", 0.40, 0, 500000),
    "CRTE": ("Cuenta Corriente", 0.30, 0, 250000),
    "PRES": ("Prestamo Personal", 0.20, 1000, 1000000),
    "INVR": ("Cuenta de Inversion", 0.10, 0, 100000),
}


def code_weights() -> dict[str, float]:
    """Each band's share split evenly over its codes."""
    return {
        code: BAND_SHARE[band] / len(codes) for band, codes in BANDS.items() for code in codes
    }
