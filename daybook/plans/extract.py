"""Output records: fixed-width extract, control trailer, padded text lines.

The fixed-width record is data: ``LAYOUT`` lists the 121 fields in output
order as (name, builder).  Builders take the source columns of a snapshot
row and return a Column of constant width, so every line has the same
length.

``strict=False`` (default) fixes four quirks of the original record code;
``strict=True`` reproduces them:

* ``open_dt``: blank; strict: blank when the office is NULL, else NULL.
* ``cc``: blank when the office is NULL; strict: no guard (NULL line).
* ``amount`` / ``cap_amount``: absolute value (a sign field precedes them);
  strict: the sign stays inside the zero padding (``0000…-12.50``).
* ``fec_cont`` / ``intf_dt``: the run date; strict: 2024-01-01.

Source columns: oficina, estado, producto, fechacierre, rut, numcta,
fechaaperut, saldo, saldo_bloqueado (the names of ``balance_snapshot``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daybook.functions.codes import sign, state_code
from daybook.functions.dates import text_date
from daybook.functions.text import (blank_if_null, blanks, collecting_faults, fit_left, fit_right, join_fields, pad_left,
                                    zeros_text)
from daybook.session import Scope, program_scope
from daybook.sinks import join_parts

# Fixed value: the date the original record code writes in strict mode.
STRICT_DATE = "2024-01-01"


def _lit(text: str):
    return lambda c: F.lit(text)


def _B(n: int):
    return lambda c: blanks(n)


def _Z(text: str, n: int):
    return lambda c: zeros_text(text, n)


def _ymd(col: Column) -> Column:
    return F.date_format(col, "yyyyMMdd")


def _amount(col: str, scale: int):
    def build(c):
        x = F.col(col)
        v = x if c["strict"] else F.abs(x)
        return F.when(x.isNull(), zeros_text("0", 20)).otherwise(
            fit_left(F.round(v, scale), 20))
    return build


def _date_field(col: str, n: int = 8, text: bool = False):
    def build(c):
        d = text_date(col) if text else F.col(col)
        return blank_if_null(d, n, _ymd(d))
    return build


def _run_date(c):
    return F.lit((STRICT_DATE if c["strict"] else c["run_date"]).replace("-", ""))


def _open_dt(c):
    if c["strict"]:
        return F.when(F.col("oficina").isNull(), blanks(8))
    return blanks(8)


def _cc(c):
    if c["strict"]:
        return fit_right("oficina", 10)
    return blank_if_null("oficina", 10)


# The record layout, in output order (name, builder).
LAYOUT = [
    ("ctry", _lit("CL ")),
    ("fec_cont", _run_date),
    ("intf_dt", _run_date),
    ("src_id", lambda c: fit_right(F.lit("OPB3"), 14)),
    ("cem", _lit("012")),
    ("of_cta", lambda c: blank_if_null("oficina", 10)),
    ("state", lambda c: state_code("estado", 10)),
    ("dinq_sta", _lit("1")),
    ("prod", lambda c: fit_right(F.concat(F.lit("CBC "), F.col("producto")), 16)),
    ("open_dt", _open_dt),
    ("lst_accr_dt", _date_field("fechacierre")),
    ("resp_rut", lambda c: blank_if_null("rut", 25, fit_left("rut", 11))),
    ("cc", _cc),
    ("nro_cta", lambda c: blank_if_null("numcta", 30)),
    ("fec_ini", _date_field("fechaaperut", text=True)),
    ("closed_date", _date_field("fechacierre")),
    ("fec_ren", _B(8)),
    ("int_antc", _B(8)),
    ("cod_moned", _lit("999 ")),
    ("sig", lambda c: sign("saldo")),
    ("amount", _amount("saldo", 4)),
    ("sig_amount", lambda c: sign("saldo")),
    ("cap_amount", _amount("saldo", 2)),
    ("lin_cred_amount", _Z("0.0000", 20)),
    ("lcy_reaj_amnt_sig", _lit("+")),
    ("lcy_reaj_amnt", _Z("0.00", 20)),
    ("ocy_int_amnt_sig", _lit("+")),
    ("ocy_int_amnt", _Z("0.0000", 20)),
    ("lcy_int_amnt_sig", _lit("+")),
    ("lcy_int_amnt", _Z("0.00", 20)),
    ("fix_flting_ind", _lit("  ")),
    ("int_rt_cod", _lit("    ")),
    ("int_rt", lambda c: F.concat(F.lit("+"), zeros_text("0.00000000", 16))),
    ("pnlt_rt", _Z("0.00000000", 17)),
    ("rt_meth", _lit(" ")),
    ("pool_rt", _Z("0.00000000", 17)),
    ("pool_rt_cod", lambda c: F.lpad(F.lit("0"), 5, " ")),
    ("pnlt_rt_cod", _lit("    ")),
    ("int_rt_sprd", _Z("0.00000000", 17)),
    ("pool_rt_sprd", _Z("0.00000000", 17)),
    ("pnlt_rt_sprd", _Z("0.00000000", 17)),
    ("aset_liad_ind", _lit("P")),
    ("sbif_bal_no_rep_sign", _lit(" ")),
    ("sbif_bal_no_rep", _Z("0.00", 20)),
    ("sbif_tipo_tasa", _lit("0000")),
    ("sbif_prod_trans", _lit("00")),
    ("sbif_tipo_oper_trans", _lit("0")),
    ("lcy_fee_amt_sign", _lit("+")),
    ("orig_strt_dt", _B(8)),
    ("nacc_from_dt", _B(8)),
    ("pdue_from_dt", _B(8)),
    ("wrof_from_dt", _B(8)),
    ("orig_con_no", _B(30)),
    ("no_of_remn_coup", lambda c: F.rpad(F.lit("0"), 4, "0")),
    ("no_of_pdo_coup", lambda c: F.rpad(F.lit("0"), 4, "0")),
    ("no_of_tot_coup", lambda c: F.rpad(F.lit("0"), 4, "0")),
    ("sbif_dest_coloc", lambda c: F.rpad(F.lit("0"), 3, "0")),
    ("stop_accr_dt", _B(8)),
    ("lst_int_pymt_dt", _B(8)),
    ("ren_ind", _lit(" ")),
    ("lst_rset_dt", _B(8)),
    ("next_rt_ch_dt", _B(8)),
    ("lst_rt_ch_dt", _B(8)),
    ("ocy_orig_nom_amt", _Z("0.0000", 20)),
    ("balAvl", lambda c: F.when(F.col("saldo_bloqueado").isNull(), zeros_text("0.00", 20)).otherwise(
        fit_left(F.round(F.col("saldo_bloqueado"), 2), 20))),
    ("lcy_pdo1_amt", _Z("0.0000", 20)),
    ("lcy_pdo2_amt", _Z("0.0000", 20)),
    ("Lcy_pdo3_amt", _Z("0.0000", 20)),
    ("lcy_oper_amt", _Z("0.0000", 20)),
    ("loc", _Z("0.0000", 20)),
    ("lcy_mnpy", _Z("0.0000", 20)),
    ("lgl_actn_ind", _lit(" ")),
    ("Lcy_mv", _Z("0.0000", 20)),
    ("Lcy_par_val", _Z("0.0000", 20)),
    ("Port_typ", _lit("0")),
    ("No_rng", _lit("000")),
    ("Pdc_coup", _lit("00000")),
    ("Pgo_amt", _Z("0.0000", 20)),
    ("con_no_typ", _lit(" ")),
    ("ope_typ", _lit(" ")),
    ("mod_entr_bs", _lit("S ")),
    ("opc_compra", _Z("0.00", 13)),
    ("ident_instr", _B(5)),
    ("ident_emi_instr", _B(25)),
    ("serie_instr", _B(4)),
    ("subserie_instr", _B(5)),
    ("cat_risk_instr", _B(8)),
    ("limit_rate", _Z("0.00000000", 17)),
    ("pdc_after_fix_per", _Z("0", 4)),
    ("lcy_pdo4_amt", _Z("0", 19)),
    ("lcy_pdo5_amt", _Z("0", 19)),
    ("lcy_pdo6_amt", _Z("0", 19)),
    ("sbif_no_rep_ind", _lit("S")),
    ("Lcy_otr_cont_amt", _Z("0", 19)),
    ("lcy_pdo7_amt", _Z("0", 19)),
    ("lcy_pdo8_amt", _Z("0", 19)),
    ("lcy_pdo9_amt", _Z("0", 19)),
    ("assets_origin", _Z("0", 1)),
    ("first_expiry_dt", _B(8)),
    ("tip_otorg", _lit(" ")),
    ("price_viv", _Z("0", 19)),
    ("tip_op_reneg", _lit(" ")),
    ("mon_pie_pag_reneg", _Z("0", 19)),
    ("seg_rem_cred_hip", _lit(" ")),
    ("pdue_from_oldest", _Z("0", 8)),
    ("mon_prev_rng", _Z("0.00", 20)),
    ("exig_pago", _lit(" ")),
    ("bidding_dt", _B(8)),
    ("loan_disbursement_dt", _B(8)),
    ("Accounting_dt", _date_field("fechaaperut", text=True)),
    ("last_payment_dt", _B(8)),
    ("last_amount_paid", _Z("0.00", 20)),
    ("credit_line_approved_dt", _B(8)),
    ("Amount_instalment", _Z("0.00", 20)),
    ("Amount_revolving", _Z("0.00", 20)),
    ("Ind_credit_line_duration", _lit(" ")),
    ("nat_con_no", lambda c: F.lpad(F.lit("12"), 4, " ")),
    ("dest_finan", _lit(" ")),
    ("no_post_coup", _Z("0", 3)),
    ("giro", lambda c: F.lpad(F.lit(" "), 2, " ")),
    ("sbif_cust_act_eco", _B(10)),
]


def record_columns(df: DataFrame, run_date: str, strict: bool = False,
                   keep=("numcta",)) -> DataFrame:
    """The 121 fields as named columns (plus ``keep``)."""
    ctx = {"strict": strict, "run_date": run_date}
    return df.select(*[F.col(k) for k in keep],
                     *[build(ctx).alias(name) for name, build in LAYOUT])


def fixed_width_lines(df: DataFrame, run_date: str, strict: bool = False) -> DataFrame:
    """One line per input row: ``numcta`` and ``line`` (all fields joined).  A value that
    does not fit stops the run; see ``checked_lines``."""
    ctx = {"strict": strict, "run_date": run_date}
    return df.select("numcta", F.concat(*[build(ctx) for _, build in LAYOUT]).alias("line"))


def checked_lines(df: DataFrame, run_date: str, strict: bool = False) -> DataFrame:
    """One row per input row: ``numcta``, ``line`` and ``faults``, an array of (field,
    length, width) of the values that do not fit.  A record with faults has no line."""
    ctx, parts, faults = {"strict": strict, "run_date": run_date}, [], []
    for name, build in LAYOUT:
        with collecting_faults() as found:
            parts.append(build(ctx))
        faults += [F.when(length > width, F.struct(F.lit(name).alias("field"), length.alias("length"), F.lit(width).alias("width")))
                   for length, width in found]
    out = df.select("numcta", F.concat(*parts).alias("line"), F.filter(F.array(*faults), lambda x: x.isNotNull()).alias("faults"))
    return out.withColumn("line", F.when(F.size("faults") == 0, F.col("line")))


def good_lines(df: DataFrame, run_date: str, strict: bool = False) -> DataFrame:
    """``numcta`` and ``line`` of the records that fit the layout."""
    return checked_lines(df, run_date, strict).filter(F.size("faults") == 0).select("numcta", "line")


def rejected_fields(checked: DataFrame) -> DataFrame:
    """(numcta, field, length, width) of each value that does not fit."""
    return checked.select("numcta", F.explode("faults").alias("f")).select("numcta", "f.*")


def trailer_text(run_date_yyyymmdd: str, n: int) -> str:
    """The trailer of ``n`` written lines; a count of over 8 digits stays whole."""
    return f"099, {run_date_yyyymmdd}, {str(n).rjust(8, '0')}"


@dataclass(frozen=True)
class Written:
    lines: int
    rejected: int


def write_extract(checked: DataFrame, path: str, rejects: str, run_date_yyyymmdd: str, single_file: bool = False) -> Written:
    """Write ``checked_lines`` in one pass: good lines in account order and their trailer
    as text to ``path``, rejected records as JSON lines (numcta, fields) to ``rejects``.

    Rows are sorted by (kind, numcta) and written to a folder per kind; the counts come
    from an ``Observation`` on that write, after the sort, where each task that counts
    also writes.  So nothing is computed twice and nothing saved first.  The trailer
    counts the written lines; the folders are renamed into place when all is written.
    """
    spark = checked.sparkSession
    bad = F.size("faults") > 0
    reject = F.to_json(F.struct("numcta", F.col("faults").alias("fields")))
    rows = checked.select(F.when(bad, "rejects").otherwise("lines").alias("kind"), "numcta",
                          F.when(bad, reject).otherwise(F.col("line")).alias("value"))
    seen = Observation("extract")
    rows = rows.orderBy("kind", "numcta").observe(seen, F.count_if(F.col("kind") == "lines").alias("lines"),
                                                  F.count_if(F.col("kind") == "rejects").alias("rejected"))
    jvm = spark._jvm
    with Scope(spark, "extract") as scope:
        folder = scope.new_path("parts")
        rows.select("kind", "value").write.partitionBy("kind").text(folder)
        got = Written(**seen.get)
        trailer = trailer_text(run_date_yyyymmdd, got.lines) + "\n"
        for kind, target in (("lines", path), ("rejects", rejects)):
            src, to = (jvm.org.apache.hadoop.fs.Path(x) for x in (f"{folder}/kind={kind}", target))
            fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
            fs.delete(to, True)
            fs.mkdirs(to.getParent())
            if kind == "lines" and single_file:
                fs.mkdirs(to)
                one = f"{target.rstrip('/')}/part-00000"
                if got.lines:
                    join_parts(spark, src.toString(), one, last=trailer.encode())
                else:
                    _put(fs, jvm.org.apache.hadoop.fs.Path(one), trailer)
                continue
            if getattr(got, "lines" if kind == "lines" else "rejected"):
                if not fs.rename(src, to):
                    raise OSError(f"cannot rename {src.toString()} to {target}")
            else:
                fs.mkdirs(to)
            if kind == "lines":     # last in name order: letters come after digits
                _put(fs, jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/part-trailer.txt"), trailer)
    return got


def _put(fs, path, text: str) -> None:
    out = fs.create(path, True)
    out.write(bytearray(text.encode()))
    out.close()


def control_trailer(df: DataFrame, run_date_yyyymmdd: str) -> DataFrame:
    """``099, <yyyymmdd>, <row count filled up with '0' to 8 digits>``: one row,
    computed by an aggregate (no driver round trip).  A longer count stays whole."""
    return df.agg(F.concat(F.lit(f"099, {run_date_yyyymmdd}, "),
                           pad_left(F.count(F.lit(1)), 8)).alias("line"))


def lines_with_trailer(lines: DataFrame, run_date_yyyymmdd: str, path: str | None = None) -> DataFrame:
    """Data lines then the trailer, with an order column: ``rec_order`` is 0 for data and
    1 for the trailer, ``numcta`` orders the data lines.

    The data rows are written to ``path`` (by default in the program's scope),
    observed by the count that the trailer states; so the lines are computed once.
    The result reads them back.
    """
    spark, seen = lines.sparkSession, Observation("lines")
    path = path or program_scope(spark).new_path("extract-lines")
    data = lines.select(F.lit(0).alias("rec_order"), "numcta", "line")
    data.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    trailer = spark.createDataFrame([(1, None, trailer_text(run_date_yyyymmdd, seen.get["n"]))], "rec_order int, numcta string, line string")
    return spark.read.schema(data.schema).parquet(path).unionByName(trailer)


def padded_columns(df: DataFrame, width: int = 14) -> DataFrame:
    """Account, transaction id and amount filled up with '0' to ``width``; longer ones stay whole."""
    return df.select(pad_left("numcta", width).alias("ctaid_padded"),
                     pad_left("transactionid", width).alias("transactionid_padded"),
                     pad_left("amount", width).alias("total_amount_padded"))


def delimited_lines(padded: DataFrame, sep: str = ";") -> DataFrame:
    return padded.select(join_fields(sep, *padded.columns).alias("line"))


def attribute_dump(cfv: DataFrame, width: int = 35, sep: str = "+") -> DataFrame:
    """Every attribute row as one line: value, key, own key and parent key,
    each filled up with '0' to ``width`` (longer ones whole), joined with
    ``sep`` (NULL fields skipped)."""
    cols = ["value", "customfieldkey", "encodedkey", "parentkey"]
    return cfv.select(join_fields(sep, *[pad_left(c, width) for c in cols]).alias("line"))
