"""Column contracts of the banking data product.

Each line is: source column, type (`!` = required), descriptive name. `-` means that
the column is not carried over.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Master columns.
MASTER = """
CUSTID bigint! identificador_cliente
CUSTNM string nombre_completo_cliente
FRSTNM string primer_nombre
MDLNM string segundo_nombre
LSTNM string primer_apellido
SCNDLN string segundo_apellido
GNDR string genero
IDTYPE string tipo_documento_identidad
IDNMBR string numero_documento_identidad
NATNLT string codigo_nacionalidad
MRTLST string estado_civil
ADDR1 string direccion_linea_uno
ADDR2 string direccion_linea_dos
CITY string ciudad_residencia
STATE string estado_provincia
ZPCDE string codigo_postal
CNTRY string pais_residencia
PHONE1 string telefono_principal
PHONE2 string telefono_secundario
EMAIL string correo_electronico
OCCPTN string ocupacion_profesion
EMPLYR string nombre_empleador
EMPADS string direccion_empleador
BRNCOD string codigo_sucursal_cliente
BRNNM string nombre_sucursal_cliente
SGMNT string segmento_cliente
CSTCAT string categoria_cliente
RISKLV string nivel_riesgo_cliente
PRDTYP string tipo_producto_principal
ACCTST string estado_cuenta_cliente
TXID string identificador_fiscal
LGLLNM string nombre_legal_completo
MTHNM string nombre_madre
FTHNM string nombre_padre
CNTPRS string persona_contacto_emergencia
CNTPH string telefono_contacto_emergencia
PREFNM string nombre_preferido
LANG string idioma_preferido
EDLVL string nivel_educativo
INCSRC string fuente_ingresos
RELTYP string tipo_relacion_bancaria
NTFPRF string preferencia_notificacion
BRTDT date fecha_nacimiento
OPNDT date fecha_apertura_cuenta
LSTTRX date fecha_ultima_transaccion
LSTUPD date fecha_ultima_actualizacion
CRTNDT date fecha_creacion_registro
EXPDT date fecha_vencimiento_documento
EMPSDT date fecha_inicio_empleo
LSTLGN date fecha_ultimo_login_digital
RVWDT date fecha_revision_kyc
VLDDT date fecha_validacion_datos
ENRLDT date fecha_enrolamiento_digital
CNCLDT date fecha_cancelacion_maestro
RJCTDT date fecha_rechazo
PRMDT date fecha_promocion_segmento
CHGDT date fecha_cambio_estado
LSTCDT date fecha_ultimo_contacto
NXTRVW date fecha_proxima_revision
BKRLDT date fecha_relacion_banco
ANNLINC double ingreso_anual_declarado
MNTHINC double ingreso_mensual
CRDSCR bigint puntaje_crediticio
DPNDNT bigint numero_dependientes
TTLPRD bigint total_productos_contratados
FNCLYR bigint anio_fiscal_vigente
AGECST bigint edad_cliente
YRBNKG bigint anios_relacion_bancaria
RSKSCR double score_riesgo_calculado
NUMPHN bigint cantidad_telefonos_registrados
"""

# Transactions columns.
TRANSACTIONS = """
TRXID bigint! identificador_transaccion
CUSTID bigint! identificador_cliente
TRXTYP string tipo_transaccion
TRXDSC string descripcion_transaccion
CHNLCD string canal_transaccion
TRXSTS string estado_transaccion
CRNCOD string codigo_moneda
BRNCOD string codigo_sucursal
ATMID string identificador_atm
TRXDT date fecha_transaccion
TRXTM timestamp fecha_hora_transaccion
PRCDT date fecha_procesamiento
PRCTM timestamp fecha_hora_procesamiento
VLDT date fecha_valor
STLDT date fecha_liquidacion
PSTDT date fecha_contabilizacion
CRTDT date fecha_creacion_registro
LSTUDT date fecha_ultima_actualizacion
AUTHDT date fecha_autorizacion
CNFRDT date fecha_confirmacion
EXPDT date fecha_expiracion
RVRSDT date fecha_reverso
RCLDT date fecha_reconciliacion
NTFDT date fecha_notificacion
CLRDT date fecha_compensacion
DSPDT date fecha_disputa
RSLTDT date fecha_resolucion
BTCHDT date fecha_lote_procesamiento
EFCDT date fecha_efectiva
ARCDT date fecha_archivado
TRXAMT double monto_transaccion
ORGAMT double monto_original
FEEAMT double monto_comision
TAXAMT double monto_impuesto
NETAMT double monto_neto
BLNBFR double saldo_antes_transaccion
BLNAFT double saldo_despues_transaccion
XCHGRT double tasa_cambio
CVTAMT double monto_convertido
INTAMT double monto_intereses
DSCAMT double monto_descuento
PNLAMT double monto_penalidad
REFAMT double monto_referencia
LIMAMT double limite_permitido
AVLAMT double monto_disponible
HLDAMT double monto_retenido
OVRAMT double monto_sobregiro
MINAMT double monto_minimo_requerido
MAXAMT double monto_maximo_permitido
AVGAMT double monto_promedio_diario
CSHREC double monto_efectivo_recibido
CSHGVN double monto_efectivo_entregado
TIPAMT double monto_propina
RNDAMT double monto_redondeo
SURCHG double recargo_adicional
INSAMT double monto_seguro
ADJAMT double monto_ajuste
DLYACM double acumulado_diario
WKACM double acumulado_semanal
MTHACM double acumulado_mensual
"""

# Balances columns.
BALANCES = """
CUSTID bigint! -
ACCTID string identificador_cuenta
ACCTTYP string tipo_cuenta
ACCTNM string nombre_cuenta
ACCTST string estado_cuenta_saldo
CRNCOD string codigo_moneda_cuenta
BRNCOD string codigo_sucursal_cuenta
BRNNM string nombre_sucursal_cuenta
PRDCOD string codigo_producto
PRDNM string nombre_producto
PRDCAT string categoria_producto
SGMNT string segmento_cuenta
RISKLV string nivel_riesgo_cuenta
RGNCD string codigo_region
RGNNM string nombre_region
CSTGRP string grupo_cliente
BLKST string estado_bloqueo
EMBST string estado_embargo
OVDST string estado_mora
DGTST string estado_digital
CRDST string estado_crediticio
LNTYP string tipo_linea_credito
GRNTYP string tipo_garantia
PYMFRQ string frecuencia_pago
INTTYP string tipo_tasa_interes
TXCTG string categoria_fiscal
CHKTYP string tipo_chequera
CRDGRP string grupo_crediticio
CLSCD string codigo_clasificacion
SRCCD string codigo_fuente
AVLBAL double saldo_disponible
CURBAL double saldo_actual
HLDBAL double saldo_retenido
OVRBAL double saldo_sobregiro
PNDBAL double saldo_pendiente
AVGBAL double saldo_promedio_periodo
MINBAL double saldo_minimo_periodo
MAXBAL double saldo_maximo_periodo
OPNBAL double saldo_apertura_periodo
CLSBAL double saldo_cierre_periodo
INTACC double intereses_acumulados
INTPAY double intereses_pagados
INTRCV double intereses_recibidos
FEEACC double comisiones_acumuladas
FEEPAY double comisiones_pagadas
CRDLMT double limite_credito
CRDAVL double credito_disponible
CRDUSD double credito_utilizado
PYMAMT double monto_pago_minimo
PYMLST double ultimo_pago_realizado
TTLDBT double total_debitos_periodo
TTLCRD double total_creditos_periodo
TTLTRX bigint total_transacciones_periodo
LNAMT double monto_prestamo
LNBAL double saldo_prestamo
MTHPYM double pago_mensual
INTRT double tasa_interes_vigente
PNLRT double tasa_penalidad
OVRRT double tasa_sobregiro
TAXAMT double impuestos_acumulados
INSAMT double seguros_acumulados
DLYINT double interes_diario
YLDRT double tasa_rendimiento
SPRDRT double spread_tasa
MRGAMT double monto_margen
OPNDT date fecha_apertura_cuenta_saldo
CLSDT date fecha_cierre_cuenta
LSTTRX date fecha_ultima_transaccion_saldo
LSTPYM date fecha_ultimo_pago
NXTPYM date fecha_proximo_pago
MATDT date fecha_vencimiento_cuenta
RNWDT date fecha_renovacion
RVWDT date fecha_revision_cuenta
CRTDT date fecha_creacion_registro_saldo
UPDDT date fecha_actualizacion_saldo
STMDT date fecha_estado_cuenta
CUTDT date fecha_corte
GRPDT date fecha_periodo_gracia
INTDT date fecha_calculo_intereses
FEEDT date fecha_cobro_comisiones
BLKDT date fecha_bloqueo
EMBDT date fecha_embargo
OVDDT date fecha_inicio_mora
PYMDT1 date fecha_primer_pago
PYMDT2 date fecha_segundo_pago
PRJDT date fecha_proyeccion
ADJDT date fecha_ajuste
RCLDT date fecha_reconciliacion
NTFDT date fecha_notificacion_cuenta
CNCLDT date fecha_cancelacion_cuenta
RCTDT date fecha_reactivacion
CHGDT date fecha_cambio_condiciones
VRFDT date fecha_verificacion
PRMDT date fecha_promocion_cuenta
DGTDT date fecha_acceso_digital
AUDT date fecha_auditoria
MGRDT date fecha_migracion
ESCDT date fecha_escalamiento
RPTDT date fecha_reporte_regulatorio
ARCDT date fecha_archivado_cuenta
"""

# Descriptive names of the ingest timestamp per source.
INGESTED_AS = {
    "master": "fecha_ingesta_maestro",
    "transactions": "fecha_ingesta_datos",
    "balances": "fecha_ingesta_saldo",
}

# Clustering columns of the seven tables.
CLUSTERING = {
    "cmstfl": ["FechaIngestaDatos", "CUSTID"],
    "trxpfl": ["TRXDT", "CUSTID", "TRXTYP"],
    "blncfl": ["FechaIngestaDatos", "CUSTID"],
    "clientes_saldos_consolidados": ["huella_identificacion_cliente", "identificador_cliente"],
    "transacciones_enriquecidas": [
        "fecha_transaccion",
        "identificador_cliente",
        "tipo_transaccion",
    ],
    "comportamiento_atm_cliente": ["identificador_cliente"],
    "resumen_integral_cliente": ["huella_identificacion_cliente", "identificador_cliente"],
}


def source_schema(contract: str) -> T.StructType:
    """Schema of the source table, in contract order."""
    columns = [line.split() for line in contract.split("\n") if line]
    ddl = [f"{name} {kind.replace('!', ' NOT NULL')}" for name, kind, _ in columns]
    return T.StructType.fromDDL(", ".join(ddl))


def renames(contract: str, ingested_as: str) -> dict[str, str]:
    """Source name to descriptive name, the ingest timestamp included."""
    lines = [line.split() for line in contract.split("\n") if line]
    made = {old: new for old, _, new in lines if new != "-"}
    return made | {"FechaIngestaDatos": ingested_as}
