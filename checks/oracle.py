"""SQL for the queries, written from the definitions and run on the given tables by another engine."""

from __future__ import annotations

from .fixtures import VERTICES

_RING = ", ".join(f"({code}, {no}, {x}::DOUBLE, {y}::DOUBLE)" for code, no, x, y in VERTICES)

_SEGMENT_NAME = (
    "CASE segment_code WHEN 1 THEN 'OTB' WHEN 2 THEN 'HB' WHEN 3 THEN 'MTB' WHEN 4 THEN 'LTB' "
    "WHEN 5 THEN 'Boca Ceiga' WHEN 6 THEN 'Terra Ceia' WHEN 7 THEN 'Manatee River' END"
)

# Named steps; each may use the ones before it.
_STEPS = {
    "site": """
        SELECT c_custkey AS site_id,
               (c_custkey % 83)::DOUBLE / 10 AS Longitude, (c_custkey % 97)::DOUBLE / 10 AS Latitude,
               CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS Zone,
               (200 + c_custkey % 170)::INTEGER AS Grid
        FROM customer""",
    "physical": """
        SELECT (CASE WHEN o_orderkey % 13 = 0 THEN 'CKM' ELSE 'TBM' END) || lpad(o_orderkey::VARCHAR, 10, '0') AS Reference,
               o_orderdate AS Sampling_Date,
               CASE WHEN o_orderkey % 5 = 0 THEN 'XX' ELSE 'AM' END AS Project_1,
               CASE WHEN o_orderkey % 10 = 0 THEN 'AM' END AS Project_2,
               NULL::VARCHAR AS Project_3,
               CASE WHEN o_orderkey % 7 = 0 THEN '23' WHEN o_orderkey % 2 = 0 THEN '19' ELSE '20' END AS Gear,
               Longitude, Latitude, Zone, Grid,
               CASE WHEN o_orderkey % 3 = 0 THEN 'A' ELSE 'B' END AS Stratum
        FROM orders JOIN site ON o_custkey = site_id""",
    "numbers": """
        SELECT (CASE WHEN o_orderkey % 13 = 0 THEN 'CKM' ELSE 'TBM' END) || lpad(o_orderkey::VARCHAR, 10, '0') AS Reference,
               coalesce(l_linenumber, 1)::INTEGER AS Species_record_id,
               CASE WHEN l_orderkey IS NULL AND o_orderkey % 17 = 0 THEN '9999000000'
                    WHEN l_orderkey IS NULL THEN '9998000000'
                    ELSE (8800000000 + l_partkey * 100 + 1)::VARCHAR END AS NODCCODE,
               CASE WHEN l_linenumber = 4 THEN '2' WHEN l_linenumber = 5 THEN '' WHEN l_linenumber = 6 THEN 'N' END AS Splittype,
               CASE WHEN l_linenumber = 4 THEN (l_quantity::INTEGER % 3 + 1)::VARCHAR END AS Splitlevel,
               1 AS Cells,
               coalesce(l_quantity, 0)::INTEGER AS Number,
               CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'D'
                    WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN NULL ELSE 'F' END AS FHC
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
    "species": """
        SELECT (100000 + p_partkey)::INTEGER AS TSN, (8800000000 + p_partkey * 100 + 1)::VARCHAR AS NODCCODE,
               'Species ' || p_partkey AS Scientificname, 'Common ' || p_partkey AS Commonname,
               CASE WHEN p_partkey % 10 = 9 THEN 'N' ELSE 'Y' END AS Include_Index,
               CASE WHEN p_size % 4 = 0 THEN 'P' ELSE 'B' END AS Hab_Cat,
               CASE WHEN p_partkey % 13 = 0 THEN '' WHEN p_size % 3 = 0 THEN 'ES' WHEN p_size % 7 = 0 THEN 'FS' ELSE 'MS' END AS Est_Cat,
               CASE WHEN p_partkey % 3 = 0 THEN 'S' WHEN p_partkey % 5 = 0 THEN 'F' ELSE 'O' END AS Est_Use,
               CASE WHEN p_size % 5 = 0 THEN 'TG' ELSE 'TS' END AS Feeding_Cat,
               CASE WHEN p_partkey % 29 = 7 THEN '' ELSE CASE p_type WHEN 'STANDARD' THEN 'ZB' WHEN 'ECONOMY' THEN 'PV'
                    WHEN 'MEDIUM' THEN 'ZP' WHEN 'PROMO' THEN 'OV' WHEN 'SMALL' THEN 'HV' ELSE 'DV' END END AS Feeding_Guild,
               CASE WHEN p_partkey % 4 = 0 THEN 'Y' ELSE 'N' END AS Selected_Taxa
        FROM part
        UNION ALL SELECT 9998, '9998000000', 'No fish', 'No fish', 'Y', '.', '.', '.', '.', '.', 'N'
        UNION ALL SELECT 9999, '9999000000', 'No gear set', 'No gear set', 'N', '.', '.', '.', '.', '.', 'N'""",
    "ring": f"SELECT * FROM (VALUES {_RING}) AS t(segment_code, vertex_no, x, y)",
    "edge": """
        SELECT a.segment_code, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
        FROM ring a JOIN ring b ON a.segment_code = b.segment_code AND b.vertex_no = a.vertex_no + 1""",
    "samples": """
        SELECT *, 1.4::DOUBLE AS effort FROM physical
        WHERE substr(Reference, 1, 3) = 'TBM' AND (Project_1 = 'AM' OR Project_2 = 'AM' OR Project_3 = 'AM')
          AND Gear IN ('19', '20') AND Sampling_Date::DATE >= DATE '1995-01-01'""",
    "catch": """
        SELECT s.Reference, Project_1, Project_2, Project_3, Sampling_Date, Latitude, Longitude, Zone, Grid, Stratum,
               effort, Species_record_id, n.NODCCODE, Scientificname, Commonname, Splittype, Splitlevel, Cells, Number
        FROM numbers n JOIN samples s ON n.Reference = s.Reference JOIN species l ON l.NODCCODE = n.NODCCODE
        WHERE FHC <> 'D'""",
    "dsite": "SELECT DISTINCT Reference, Longitude, Latitude, Zone, Grid FROM catch",
    "within": f"""
        SELECT Longitude, Latitude, {_SEGMENT_NAME} AS bay_segment
        FROM (SELECT DISTINCT Longitude, Latitude FROM physical) p
        JOIN edge ON (y1 > Latitude) <> (y2 > Latitude)
                 AND Longitude < (x2 - x1) * (Latitude - y1) / (y2 - y1) + x1
        GROUP BY Longitude, Latitude, segment_code HAVING count(*) % 2 = 1""",
    "assigned": """
        SELECT d.*, w.bay_segment FROM dsite d
        LEFT JOIN within w ON w.Longitude = d.Longitude AND w.Latitude = d.Latitude""",
    "kept": """
        SELECT * FROM (
          SELECT Reference, Longitude, Latitude, Zone, Grid,
                 CASE WHEN Grid = 363 THEN 'LTB' WHEN Grid IN (203, 220) THEN 'MTB'
                      WHEN Grid = 204 AND Longitude < 27.7937 THEN 'MTB' ELSE bay_segment END AS bay_segment
          FROM assigned)
        WHERE bay_segment NOT IN ('Boca Ceiga', 'Terra Ceia', 'Manatee River')""",
    "seg_catch": """
        SELECT c.*, k.bay_segment FROM catch c
        JOIN kept k ON c.Reference = k.Reference AND c.Zone IS NOT DISTINCT FROM k.Zone
                   AND c.Grid IS NOT DISTINCT FROM k.Grid""",
    "haul": """
        SELECT Reference, year(Sampling_Date)::INTEGER AS Year, month(Sampling_Date)::INTEGER AS Month,
               CASE WHEN month(Sampling_Date) IN (12, 1, 2, 3) THEN 'Winter' WHEN month(Sampling_Date) IN (4, 5) THEN 'Spring'
                    WHEN month(Sampling_Date) BETWEEN 6 AND 9 THEN 'Summer' ELSE 'Fall' END AS Season,
               bay_segment, Longitude, Latitude
        FROM (SELECT s.*, CASE WHEN Grid = 363 THEN 'LTB' WHEN Grid IN (203, 220) THEN 'MTB'
                               WHEN Grid = 204 AND s.Longitude < 27.7937 THEN 'MTB' ELSE w.bay_segment END AS bay_segment
              FROM samples s LEFT JOIN within w ON w.Longitude = s.Longitude AND w.Latitude = s.Latitude)
        WHERE bay_segment IN ('OTB', 'HB', 'MTB', 'LTB')""",
    "total": """
        SELECT n.Reference, n.NODCCODE, l.Scientificname, l.Hab_Cat, l.Est_Cat, l.Est_Use, l.Feeding_Cat, l.Feeding_Guild,
               l.Selected_Taxa,
               sum(CASE WHEN Splittype = '2' THEN Number * pow(2, Splitlevel::DOUBLE) ELSE Number END)::DOUBLE AS Total_N
        FROM numbers n JOIN species l ON l.NODCCODE = n.NODCCODE
        WHERE FHC <> 'D' AND n.NODCCODE <> '9999000000' AND Include_Index = 'Y' AND n.Reference LIKE 'TBM%'
        GROUP BY ALL""",
    "kept_all": """
        SELECT * FROM (
          SELECT Reference, p.Longitude, p.Latitude, Zone, Grid,
                 CASE WHEN Grid = 363 THEN 'LTB' WHEN Grid IN (203, 220) THEN 'MTB'
                      WHEN Grid = 204 AND p.Longitude < 27.7937 THEN 'MTB' ELSE bay_segment END AS bay_segment
          FROM physical p LEFT JOIN within w ON w.Longitude = p.Longitude AND w.Latitude = p.Latitude)
        WHERE bay_segment NOT IN ('Boca Ceiga', 'Terra Ceia', 'Manatee River')""",
    "all_sites": """
        SELECT k.Reference, k.Zone, k.Grid, k.bay_segment, c.* EXCLUDE (Reference, Zone, Grid)
        FROM catch c RIGHT JOIN kept_all k ON c.Reference = k.Reference AND c.Zone IS NOT DISTINCT FROM k.Zone
                                          AND c.Grid IS NOT DISTINCT FROM k.Grid""",
    "flawed": """
        SELECT CASE WHEN l_linenumber <> 1 OR l_orderkey % 101 <> 0 THEN p.Reference END AS Reference, Sampling_Date, Longitude, Latitude,
               CASE WHEN l_linenumber = 2 AND l_orderkey % 37 = 0 THEN 'ELSEWHERE' ELSE Zone END AS Zone, Grid,
               CASE WHEN l_linenumber = 1 AND l_partkey % 70 = 3 THEN NULL WHEN l_partkey % 60 = 7 THEN '77' || l_partkey
                    WHEN l_linenumber = 1 AND l_orderkey % 43 = 0 THEN '9998000000'
                    ELSE (8800000000 + l_partkey * 100 + 1)::VARCHAR END AS NODCCODE,
               l_linenumber = 4 AND l_partkey % 30 = 0 AS unsplit,
               CASE WHEN l_linenumber = 3 AND l_partkey % 50 = 0 THEN NULL
                    WHEN l_linenumber = 2 AND l_partkey % 40 = 1 THEN 0 ELSE l_quantity::INTEGER END AS Number
        FROM lineitem JOIN physical p ON substr(p.Reference, 4)::BIGINT = l_orderkey""",
    "copied": """
        SELECT * FROM species UNION ALL SELECT * FROM species WHERE (TSN - 100000) % 97 = 5""",
    "indiv": "SELECT Reference, sum(Total_N) AS NumIndiv FROM total GROUP BY Reference",
    "taxa": """
        SELECT Reference, count(DISTINCT NODCCODE) FILTER (NODCCODE <> '9998000000')::DOUBLE AS NumTaxa,
               count(DISTINCT Feeding_Guild)::DOUBLE AS NumGuilds,
               count(*) FILTER (Selected_Taxa = 'Y')::DOUBLE AS TaxaSelect,
               coalesce(sum(Total_N) FILTER (Selected_Taxa = 'Y'), 0) AS SelectIndiv,
               coalesce(sum(Total_N) FILTER (Scientificname = 'Species 0'), 0) AS Num_LR,
               count(*) FILTER (Feeding_Cat = 'TS')::DOUBLE AS TSTaxa, count(*) FILTER (Feeding_Cat = 'TG')::DOUBLE AS TGTaxa,
               count(*) FILTER (Hab_Cat = 'B')::DOUBLE AS BenthicTaxa, count(*) FILTER (Hab_Cat = 'P')::DOUBLE AS PelagicTaxa,
               count(*) FILTER (Est_Use = 'O')::DOUBLE AS OblTaxa, count(*) FILTER (Est_Cat = 'MS')::DOUBLE AS MSTaxa,
               count(*) FILTER (Est_Cat = 'ES')::DOUBLE AS ESTaxa,
               coalesce(sum(Total_N) FILTER (Feeding_Cat = 'TS'), 0) AS TSAbund,
               coalesce(sum(Total_N) FILTER (Feeding_Cat = 'TG'), 0) AS TGAbund,
               coalesce(sum(Total_N) FILTER (Hab_Cat = 'B'), 0) AS BenthicAbund,
               coalesce(sum(Total_N) FILTER (Hab_Cat = 'P'), 0) AS PelagicAbund,
               coalesce(sum(Total_N) FILTER (Est_Use = 'O'), 0) AS OblAbund,
               coalesce(sum(Total_N) FILTER (Est_Cat = 'ES'), 0) AS ESAbund,
               coalesce(sum(Total_N) FILTER (Est_Cat = 'MS'), 0) AS MSAbund
        FROM total GROUP BY Reference""",
    "divers": """
        SELECT Reference, 0 - sum(p * ln(p)) AS Shannon, 1 / sum(p * p) AS Simpson
        FROM (SELECT t.Reference, Total_N / NumIndiv AS p FROM total t JOIN indiv i ON i.Reference = t.Reference WHERE NumIndiv > 0)
        GROUP BY Reference""",
    "domin": """
        SELECT Reference, min(pos)::DOUBLE AS Taxa90
        FROM (SELECT t.Reference, row_number() OVER w AS pos, sum(Total_N) OVER w / NumIndiv AS share
              FROM total t JOIN indiv i ON i.Reference = t.Reference WHERE NumIndiv > 0
              WINDOW w AS (PARTITION BY t.Reference ORDER BY Total_N DESC, NODCCODE ROWS UNBOUNDED PRECEDING))
        WHERE share >= 0.9 GROUP BY Reference""",
    "metric": """
        SELECT t.Reference,
               CASE WHEN NumIndiv = 0 THEN 0 ELSE NumTaxa END AS NumTaxa, NumIndiv,
               CASE WHEN NumIndiv = 0 THEN 0 ELSE Shannon END AS Shannon,
               CASE WHEN NumIndiv = 0 THEN 0 ELSE Simpson END AS Simpson,
               CASE WHEN NumIndiv = 0 THEN 0 WHEN NumTaxa > 1 THEN Shannon / ln(NumTaxa) END AS Pielou,
               TaxaSelect, SelectIndiv,
               CASE WHEN NumIndiv = 0 THEN 0 ELSE NumGuilds END AS NumGuilds,
               CASE WHEN NumIndiv = 0 THEN 0 ELSE Taxa90 END AS Taxa90,
               TSTaxa, TGTaxa, BenthicTaxa, PelagicTaxa, OblTaxa, MSTaxa, ESTaxa,
               TSAbund, TGAbund, BenthicAbund, PelagicAbund, OblAbund, ESAbund, MSAbund, Num_LR,
               coalesce(TGAbund / nullif(NumIndiv, 0), 0) AS PropTG, coalesce(TSAbund / nullif(NumIndiv, 0), 0) AS PropTS,
               coalesce(BenthicAbund / nullif(NumIndiv, 0), 0) AS PropBenthic,
               coalesce(PelagicAbund / nullif(NumIndiv, 0), 0) AS PropPelagic,
               coalesce(OblAbund / nullif(NumIndiv, 0), 0) AS PropObl, coalesce(MSAbund / nullif(NumIndiv, 0), 0) AS PropMS,
               coalesce(ESAbund / nullif(NumIndiv, 0), 0) AS PropES, coalesce(SelectIndiv / nullif(NumIndiv, 0), 0) AS PropSelect
        FROM taxa t JOIN indiv i ON i.Reference = t.Reference
        LEFT JOIN divers d ON d.Reference = t.Reference LEFT JOIN domin m ON m.Reference = t.Reference""",
    "haul_metric": """
        SELECT h.Reference, Year, Month, Season, bay_segment, Longitude, Latitude, m.* EXCLUDE (Reference)
        FROM haul h JOIN metric m ON m.Reference = h.Reference""",
    "refcond": """
        SELECT bay_segment, Season,
               round_even(quantile_cont(NumTaxa, 0.05), 0) AS NumTaxa_P5, round_even(quantile_cont(NumTaxa, 0.95), 0) AS NumTaxa_P95,
               quantile_cont(Shannon, 0.05) AS Shannon_P5, quantile_cont(Shannon, 0.95) AS Shannon_P95,
               round_even(quantile_cont(TaxaSelect, 0.05), 0) AS TaxaSelect_P5, round_even(quantile_cont(TaxaSelect, 0.95), 0) AS TaxaSelect_P95,
               round_even(quantile_cont(BenthicTaxa, 0.05), 0) AS BenthicTaxa_P5, round_even(quantile_cont(BenthicTaxa, 0.95), 0) AS BenthicTaxa_P95,
               round_even(quantile_cont(NumGuilds, 0.05), 0) AS NumGuilds_P5, round_even(quantile_cont(NumGuilds, 0.95), 0) AS NumGuilds_P95
        FROM haul_metric WHERE Year BETWEEN 1996 AND 1999 GROUP BY bay_segment, Season""",
    "scored": """
        SELECT Reference, Year, Month, Season, bay_segment, Longitude, Latitude,
               round_even(CASE WHEN NumTaxa = 0 THEN 0 WHEN NumTaxa > NumTaxa_P95 THEN 10
                          ELSE (NumTaxa - NumTaxa_P5) / nullif(NumTaxa_P95 - NumTaxa_P5, 0) * 10 END, 0) + 0.0::DOUBLE AS ScoreNumTaxa,
               round_even(CASE WHEN NumTaxa = 0 THEN 0 WHEN Shannon > Shannon_P95 THEN 10
                          ELSE (Shannon - Shannon_P5) / nullif(Shannon_P95 - Shannon_P5, 0) * 10 END, 0) + 0.0::DOUBLE AS ScoreShannon,
               round_even(CASE WHEN NumTaxa = 0 THEN 0 WHEN TaxaSelect > TaxaSelect_P95 THEN 10
                          ELSE (TaxaSelect - TaxaSelect_P5) / nullif(TaxaSelect_P95 - TaxaSelect_P5, 0) * 10 END, 0) + 0.0::DOUBLE AS ScoreTaxaSelect,
               round_even(CASE WHEN NumTaxa = 0 THEN 0 WHEN BenthicTaxa > BenthicTaxa_P95 THEN 10
                          WHEN BenthicTaxa < BenthicTaxa_P5 THEN 0
                          ELSE (BenthicTaxa - BenthicTaxa_P5) / nullif(BenthicTaxa_P95 - BenthicTaxa_P5, 0) * 10 END, 0) + 0.0::DOUBLE AS ScoreTaxaBenthic,
               round_even(CASE WHEN NumTaxa = 0 THEN 0 WHEN NumGuilds > NumGuilds_P95 THEN 10
                          ELSE (NumGuilds - NumGuilds_P5) / nullif(NumGuilds_P95 - NumGuilds_P5, 0) * 10 END, 0) + 0.0::DOUBLE AS ScoreNumGuilds
        FROM haul_metric LEFT JOIN refcond USING (bay_segment, Season)""",
    "score": """
        SELECT *, (ScoreNumTaxa + ScoreShannon + ScoreTaxaSelect + ScoreTaxaBenthic + ScoreNumGuilds) / 5 * 10 AS Index_Score
        FROM scored""",
    "yearly": """
        SELECT Year, Yr_Index, SEM, Yr_Index - SEM AS lower_sem, Yr_Index + SEM AS upper_sem
        FROM (SELECT Year, round_even(avg(Index_Score), 0) AS Yr_Index, stddev_samp(Index_Score) / sqrt(count(*)) AS SEM
              FROM score GROUP BY Year)""",
    "seg_yearly": """
        SELECT bay_segment, Year, round_even(avg(Index_Score), 0) AS Segment_Index FROM score GROUP BY bay_segment, Year""",
    "band": """
        SELECT quantile_cont(Index_Score, 0.33) AS Score_P33, quantile_cont(Index_Score, 0.5) AS Score_P50
        FROM score WHERE Year BETWEEN 1996 AND 1999""",
    "box": """
        SELECT min(Longitude) AS x0, max(Longitude) AS x1, min(Latitude) AS y0, max(Latitude) AS y1 FROM haul""",
}

_STEP_NAMES = list(_STEPS)


def _after(last: str, select: str, **changes: str) -> str:
    """The steps up to one of them, some replaced, and a final SELECT."""
    names = _STEP_NAMES[: _STEP_NAMES.index(last) + 1]
    unknown = set(changes) - set(names)
    if unknown:
        raise ValueError(f"no such step: {unknown}")
    steps = ",\n".join(f"{name} AS ({changes.get(name, _STEPS[name]).strip()})" for name in names)
    return f"WITH {steps}\n{select.strip()}"


def _round(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_PROPS = ("PropTG", "PropTS", "PropBenthic", "PropPelagic", "PropObl", "PropMS", "PropES", "PropSelect")
_ROUNDED_METRICS = (
    "Reference, Year, Month, Season, bay_segment, Longitude, Latitude, NumTaxa, NumIndiv, "
    + _round("Shannon", "Simpson", "Pielou")
    + ", TaxaSelect, SelectIndiv, NumGuilds, Taxa90, TSTaxa, TGTaxa, BenthicTaxa, PelagicTaxa, OblTaxa, MSTaxa, ESTaxa, "
    "TSAbund, TGAbund, BenthicAbund, PelagicAbund, OblAbund, ESAbund, MSAbund, Num_LR, " + _round(*_PROPS)
)


def _metric(columns: str) -> str:
    return _after("metric", f"SELECT Reference, {columns} FROM metric")


_DATED = "* REPLACE (Sampling_Date::DATE::VARCHAR AS Sampling_Date)"

_COLOUR = "CASE WHEN {0} <= 32 THEN '#FF0000' WHEN {0} >= 46 THEN '#008000' ELSE '#FFFF00' END"

# Metrics with every record counted as it is: the second table of the comparison.
_PLAIN = {
    f"{name}0": _STEPS[name]
    .replace("sum(CASE WHEN Splittype = '2' THEN Number * pow(2, Splitlevel::DOUBLE) ELSE Number END)", "sum(Number)")
    .replace("FROM total", "FROM total0")
    .replace("JOIN indiv", "JOIN indiv0")
    .replace("FROM taxa", "FROM taxa0")
    .replace("JOIN divers", "JOIN divers0")
    .replace("JOIN domin", "JOIN domin0")
    for name in ("total", "indiv", "taxa", "divers", "domin", "metric")
}


def _compare() -> str:
    start = _after("metric", "")
    plain = ",\n".join(f"{name} AS ({body.strip()})" for name, body in _PLAIN.items())
    parts = " UNION ALL ".join(
        f"SELECT a.Reference, 'differs' AS status, '{c}' AS \"column\", round(a.{c}, 6) AS value_a, round(b.{c}, 6) AS value_b, "
        f"round(abs(a.{c} - b.{c}), 6) AS difference FROM ra a JOIN rb b ON a.Reference IS NOT DISTINCT FROM b.Reference "
        f"WHERE abs(a.{c} - b.{c}) > 0.1"
        for c in ("NumTaxa", "NumIndiv", "Shannon", "Taxa90")
    )

    def table(metric: str, left_out: int) -> str:
        rows = f"SELECT Reference, NumTaxa, NumIndiv, round(Shannon, 6) AS Shannon, Taxa90 FROM {metric} WHERE NumTaxa <> {left_out}"
        return f"({rows}) UNION ALL SELECT NULL, max(NumTaxa), max(NumIndiv), max(Shannon), max(Taxa90) FROM ({rows})"

    lone = "SELECT {0}.Reference, 'only_{0}', NULL, NULL, NULL, NULL FROM r{0} {0} WHERE NOT EXISTS (SELECT 1 FROM r{1} o WHERE o.Reference IS NOT DISTINCT FROM {0}.Reference)"
    return (
        f"{start},\n{plain},\nra AS ({table('metric', 1)}),\nrb AS ({table('metric0', 3)})\n{parts}\n"
        f"UNION ALL {lone.format('a', 'b')}\nUNION ALL {lone.format('b', 'a')}\n"
        "UNION ALL SELECT NULL, 'column_only_a', 'NumGuilds', NULL, NULL, NULL"
    )


_MEANS = "SELECT Year, bay_segment, round_even(avg(Index_Score), 0) AS SegScore FROM score WHERE Year = 1999 GROUP BY ALL"

ORACLE: dict[str, str] = {
    "select_samples": _after(
        "samples", f"SELECT {_DATED} FROM samples WHERE Sampling_Date::DATE >= DATE '1998-01-01'"
    ),
    "build_catch": _after("catch", f"SELECT {_DATED} FROM catch"),
    "distinct_sites": _after("dsite", "SELECT * FROM dsite"),
    "assign_segments": _after("assigned", "SELECT * FROM assigned"),
    "override_segments": _after("kept", "SELECT * FROM kept"),
    "override_segments_documented": _after(
        "kept", "SELECT * FROM kept", kept=_STEPS["kept"].replace("Longitude < 27.7937", "Latitude < 0.5")
    ),
    "attach_segments": _after("all_sites", f"SELECT {_DATED} FROM all_sites"),
    "expanded_counts": _after(
        "numbers",
        """
        SELECT Splittype, Splitlevel, count(*) AS records, sum(Number)::DOUBLE AS counted,
               sum(CASE WHEN Splittype = '2' THEN Number * pow(2, Splitlevel::DOUBLE) ELSE Number END)::DOUBLE AS expanded
        FROM numbers GROUP BY Splittype, Splitlevel""",
    ),
    "prepare_counts": _after(
        "seg_catch",
        """
        SELECT c.Reference, c.NODCCODE, Sampling_Date::DATE::VARCHAR AS Sampling_Date, Latitude, Longitude, Zone, Grid, Stratum,
               c.Scientificname, c.Commonname, bay_segment, substr(c.Reference, 1, 2) AS Bay,
               year(Sampling_Date)::INTEGER AS Year, month(Sampling_Date)::INTEGER AS Month,
               sum(CASE WHEN Splittype = '2' THEN Number * pow(2, Splitlevel::DOUBLE) ELSE Number END)::DOUBLE AS Total_N,
               TSN, Include_Index, Hab_Cat, Est_Cat, Est_Use, Feeding_Cat, Feeding_Guild, Selected_Taxa
        FROM seg_catch c JOIN species l ON l.NODCCODE = c.NODCCODE
        WHERE c.NODCCODE <> '9999000000' AND Include_Index = 'Y' GROUP BY ALL""",
    ),
    "num_taxa": _metric("NumTaxa"),
    "num_indiv": _metric("NumIndiv"),
    "diversity": _metric(_round("Shannon", "Simpson", "Pielou")),
    "dominance_taxa90": _metric("Taxa90"),
    "taxa_select": _metric("TaxaSelect, SelectIndiv"),
    "num_guilds": _metric("NumGuilds"),
    "guild_taxa": _metric("TSTaxa, TGTaxa, BenthicTaxa, PelagicTaxa, OblTaxa, MSTaxa, ESTaxa"),
    "guild_abundance": _metric("TSAbund, TGAbund, BenthicAbund, PelagicAbund, OblAbund, ESAbund, MSAbund"),
    "sentinel_abundance": _metric("Num_LR"),
    "proportions": _metric(_round(*_PROPS)),
    "survey_hauls": _after("haul", "SELECT * FROM haul"),
    "sample_metrics": _after("haul_metric", f"SELECT {_ROUNDED_METRICS} FROM haul_metric"),
    "sample_metrics_stepwise": _after("haul_metric", f"SELECT {_ROUNDED_METRICS} FROM haul_metric"),
    "reference_conditions": _after(
        "refcond",
        "SELECT * REPLACE (round(Shannon_P5, 6) AS Shannon_P5, round(Shannon_P95, 6) AS Shannon_P95) FROM refcond",
    ),
    "metric_scores": _after("scored", "SELECT * FROM scored"),
    "metric_scores_p25": _after(
        "scored",
        "SELECT * FROM scored",
        refcond=_STEPS["refcond"].replace("0.05", "0.25").replace("_P5,", "_P25,"),
        scored=_STEPS["scored"].replace("_P5)", "_P25)").replace("_P5,", "_P25,").replace("_P5 ", "_P25 "),
    ),
    "index_scores": _after("score", "SELECT * REPLACE (round(Index_Score, 6) AS Index_Score) FROM score"),
    "yearly_scores": _after("yearly", f"SELECT Year, Yr_Index, {_round('SEM', 'lower_sem', 'upper_sem')} FROM yearly"),
    "segment_scores": _after("seg_yearly", "SELECT * FROM seg_yearly"),
    "band_percentiles": _after("band", f"SELECT {_round('Score_P33', 'Score_P50')} FROM band"),
    "banded_years": _after(
        "band",
        f"""
        SELECT Year, Yr_Index, {_round("SEM", "lower_sem", "upper_sem")},
               (SELECT round(Score_P33, 6) FROM band) AS Red, (SELECT round(Score_P50, 6) FROM band) AS Yellow,
               100.0::DOUBLE AS Green
        FROM yearly""",
    ),
    "banded_segments": _after(
        "band",
        """
        SELECT *, (SELECT round(Score_P33, 6) FROM band) AS Red, (SELECT round(Score_P50, 6) FROM band) AS Yellow,
               100.0::DOUBLE AS Green
        FROM seg_yearly""",
    ),
    "colour_classes": _after(
        "score", f"SELECT Reference, Year, {_COLOUR.format('Index_Score')} AS MapCol FROM score"
    ),
    "year_map_samples": _after(
        "score",
        f"""
        SELECT Reference, Year, bay_segment, Longitude, Latitude, round(Index_Score, 6) AS Index_Score, SegScore,
               {_COLOUR.format("Index_Score")} AS MapCol
        FROM (SELECT * FROM score WHERE Year = 1999) LEFT JOIN ({_MEANS}) USING (Year, bay_segment)""",
    ),
    "year_map_segments": _after(
        "score",
        f"""
        SELECT segment_code, bay_segment, Year, SegScore,
               CASE WHEN Year IS NOT NULL THEN {_COLOUR.format("SegScore")} END AS MapCol
        FROM (SELECT DISTINCT segment_code::INTEGER AS segment_code, {_SEGMENT_NAME} AS bay_segment FROM ring)
        LEFT JOIN ({_MEANS}) USING (bay_segment)
        WHERE bay_segment IN ('OTB', 'HB', 'MTB', 'LTB')""",
    ),
    "padded_extent": _after(
        "box",
        """
        SELECT round(x0 - 0.25 * (x1 - x0), 6) AS xmin, round(y0 - 0.1 * (y1 - y0), 6) AS ymin,
               round(x1 + 0.25 * (x1 - x0), 6) AS xmax, round(y1 + 0.1 * (y1 - y0), 6) AS ymax
        FROM box""",
    ),
    "within_extent": _after(
        "box",
        """
        SELECT Reference, Longitude, Latitude FROM physical JOIN box
          ON Longitude BETWEEN x0 + 0.25 * (x1 - x0) AND x1 - 0.25 * (x1 - x0)
         AND Latitude BETWEEN y0 + 0.1 * (y1 - y0) AND y1 - 0.1 * (y1 - y0)""",
    ),
    "compare_tables": _compare(),
    "quality_report": _after(
        "copied",
        """
        SELECT 'unknown_code' AS "check", item, count(*) AS n
        FROM (SELECT unnest(['Hab_Cat', 'Est_Cat', 'Est_Use', 'Feeding_Cat', 'Feeding_Guild']) AS item,
                     unnest([Hab_Cat IN ('B', 'P'), Est_Cat IN ('MS', 'ES', 'FS'), Est_Use IN ('O', 'S', 'F'), Feeding_Cat IN ('TS', 'TG'),
                             Feeding_Guild IN ('ZB', 'PV', 'ZP', 'OV', 'HV', 'DV')]) AS known
              FROM copied WHERE Include_Index = 'Y' AND NODCCODE <> '9998000000')
        WHERE NOT known GROUP BY item
        UNION ALL SELECT 'null_value', item, sum(missing::INTEGER)
        FROM (SELECT unnest(['Reference', 'NODCCODE', 'Number']) AS item,
                     unnest([Reference IS NULL, NODCCODE IS NULL, Number IS NULL]) AS missing FROM flawed)
        GROUP BY item HAVING sum(missing::INTEGER) > 0
        UNION ALL SELECT 'split_without_level', 'Splitlevel', count(*) FROM flawed WHERE unsplit HAVING count(*) > 0
        UNION ALL SELECT 'zero_count', 'Number', count(*) FROM flawed
        WHERE Number = 0 AND NODCCODE NOT IN ('9998000000', '9999000000') HAVING count(*) > 0
        UNION ALL SELECT 'duplicate_class', NODCCODE, count(*) FROM copied GROUP BY NODCCODE HAVING count(*) > 1
        UNION ALL SELECT 'unclassified_species', NODCCODE, count(*) FROM flawed
        WHERE NODCCODE NOT IN (SELECT NODCCODE FROM copied) GROUP BY NODCCODE
        UNION ALL SELECT 'mixed_no_fish', 'Reference', count(*)
        FROM (SELECT Reference FROM flawed GROUP BY Reference
              HAVING bool_or(NODCCODE = '9998000000') AND bool_or(NODCCODE IS DISTINCT FROM '9998000000'))
        HAVING count(*) > 0
        UNION ALL SELECT 'varying_attributes', 'Reference', count(*)
        FROM (SELECT Reference FROM (SELECT DISTINCT Reference, Sampling_Date, Longitude, Latitude, Zone, Grid FROM flawed)
              GROUP BY Reference HAVING count(*) > 1)
        HAVING count(*) > 0""",
    ),
    "field_metadata": """
        SELECT DISTINCT p_brand AS Data_Field_name, p_type AS Data_type, p_size::VARCHAR AS Field_length,
               NULL::VARCHAR AS Units_of_Measure, '0' AS Precision, 'Field ' || p_brand AS Description,
               NULL::VARCHAR AS Date_added, NULL::VARCHAR AS Date_discontinued
        FROM part WHERE p_brand IN ('Brand#2', 'Brand#11', 'Brand#12', 'Brand#23')
        UNION ALL SELECT 'Commonname', 'Character', NULL, NULL, NULL, 'Common name for each species', NULL, NULL
        UNION ALL SELECT 'effort', 'Decimal', NULL, 'per 100 m2', NULL, 'effort expressed per 100 m2', NULL, NULL
        UNION ALL SELECT 'Number', 'Integer', NULL, 'individuals', NULL, 'Number of individuals collected', NULL, NULL""",
    "assign_segments_text": _after("assigned", "SELECT * FROM assigned"),
    "damaged_codes": _after("haul_metric", f"SELECT {_ROUNDED_METRICS} FROM haul_metric"),
    "damaged_codes_stepwise": _after("haul_metric", f"SELECT {_ROUNDED_METRICS} FROM haul_metric"),
    "assemble": _metric("NumTaxa, NumIndiv, round(Shannon, 6) AS Shannon, TaxaSelect, SelectIndiv, NumGuilds, Taxa90"),
    "csv_species": _after("species", "SELECT * RENAME (Scientificname AS ScientificName) FROM species"),
    "csv_scores": _after(
        "score",
        """
        SELECT * REPLACE (round(Index_Score, 6) AS Index_Score),
               (SELECT 'scores_' || min(Year) || '-' || max(Year) FROM score) AS file
        FROM score""",
    ),
    "csv_texts": """
        SELECT doc_id, text, lang, source FROM documents
        UNION ALL SELECT -doc_id - 1, CASE doc_id % 8 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN ' ' WHEN 3 THEN '"'
                   WHEN 4 THEN 'a,"b",' || chr(13) || chr(10) || ',"' WHEN 5 THEN chr(92) WHEN 6 THEN chr(10) END,
               lang, CASE WHEN doc_id % 3 <> 0 THEN source END
        FROM documents""",
    "site_table": _after("kept", "SELECT * FROM kept"),
    "date_spellings": _after(
        "physical",
        """
        SELECT Reference, d::VARCHAR AS Sampling_Date, year(d)::INTEGER AS Year, month(d)::INTEGER AS Month
        FROM (SELECT Reference, CASE WHEN substr(Reference, 4)::BIGINT % 29 <> 0 AND substr(Reference, 4)::BIGINT % 31 <> 0
                                     THEN Sampling_Date::DATE END AS d FROM physical)""",
    ),
    "compare_by_digests": _compare(),
    "checked_write": _after(
        "flawed",
        """
        SELECT 'null_value' AS "check", item, sum(missing::INTEGER)::BIGINT AS n
        FROM (SELECT unnest(['Reference', 'NODCCODE', 'Number']) AS item,
                     unnest([Reference IS NULL, NODCCODE IS NULL, Number IS NULL]) AS missing FROM flawed)
        GROUP BY item HAVING sum(missing::INTEGER) > 0
        UNION ALL SELECT 'split_without_level', 'Splitlevel', count(*) FROM flawed WHERE unsplit HAVING count(*) > 0
        UNION ALL SELECT 'zero_count', 'Number', count(*) FROM flawed
        WHERE Number = 0 AND NODCCODE NOT IN ('9998000000', '9999000000') HAVING count(*) > 0""",
    ),
    "refreshed_conditions": _after(
        "refcond",
        "SELECT * REPLACE (round(Shannon_P5, 6) AS Shannon_P5, round(Shannon_P95, 6) AS Shannon_P95) FROM refcond",
    ),
    "refreshed_years": _after("yearly", f"SELECT Year, Yr_Index, {_round('SEM', 'lower_sem', 'upper_sem')} FROM yearly"),
    "refreshed_segments": _after("seg_yearly", "SELECT * FROM seg_yearly"),
    "colocated_catch": _after("catch", f"SELECT {_DATED} FROM catch"),
    "colocated_segments": _after("all_sites", f"SELECT {_DATED} FROM all_sites"),
    "repaired_segments": _after("assigned", "SELECT * FROM assigned"),
    # The area of a polygon inside a box: along each edge, the integral of its height held to the box, over the box's width.
    "clipped_segments": _after(
        "box",
        f"""
        SELECT segment_code::INTEGER AS segment_code, {_SEGMENT_NAME} AS bay_segment, round(abs(sum(
                 CASE WHEN x2 > x1 THEN -1 ELSE 1 END * (b - a) * CASE WHEN ya = yb THEN greatest(least(ya, ymax), ymin)
                   ELSE (CASE WHEN yb < ymin THEN ymin * (yb - ymin) WHEN yb <= ymax THEN (yb * yb - ymin * ymin) / 2
                              ELSE (ymax * ymax - ymin * ymin) / 2 + ymax * (yb - ymax) END
                         - CASE WHEN ya < ymin THEN ymin * (ya - ymin) WHEN ya <= ymax THEN (ya * ya - ymin * ymin) / 2
                                ELSE (ymax * ymax - ymin * ymin) / 2 + ymax * (ya - ymax) END) / (yb - ya) END)), 6) AS area
        FROM (SELECT *, y1 + (y2 - y1) * (a - x1) / (x2 - x1) AS ya, y1 + (y2 - y1) * (b - x1) / (x2 - x1) AS yb
              FROM (SELECT *, greatest(least(x1, x2), xmin) AS a, least(greatest(x1, x2), xmax) AS b
                    FROM edge, (SELECT x0 + 0.25 * (x1 - x0) AS xmin, x1 - 0.25 * (x1 - x0) AS xmax,
                                       y0 + 0.1 * (y1 - y0) AS ymin, y1 - 0.1 * (y1 - y0) AS ymax FROM box))
              WHERE x1 <> x2 AND a < b)
        GROUP BY segment_code HAVING round(area, 6) > 0""",
    ),
}
