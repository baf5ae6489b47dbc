"""The same results in plain SQL over the benchmark tables, one statement per registered query.

A statement names the tables it needs; ``statement`` puts their definitions in front of it.
"""

from __future__ import annotations

import re

LOAD = "load-1"


def total(value: str, digits: int = 2) -> str:
    """A sum rounded two digits finer first, as the reports do."""
    return f"cast(round(cast({value} as decimal(38,{digits + 2})), {digits}) as double)"


def ratio(value: str, digits: int) -> str:
    """A quotient rounded six digits finer first."""
    return f"cast(round(cast({value} as decimal(38,{digits + 6})), {digits}) as double)"


NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def _number(text: str) -> str:
    return f"case when regexp_full_match(trim({text}), '{NUMBER}') then try_cast(trim({text}) as double) end"


def _pick(field: str) -> str:
    return f"json_extract_string(raw_payload, '$.{field}')"


# Landed tables in terms of the benchmark tables, then every layer above them.
TABLES: dict[str, str] = {
    "claims": """
        select l_orderkey || '-' || l_linenumber as claim_id, cast(l_suppkey as varchar) as npi,
               cast(l_partkey as varchar) as ndc, l_extendedprice as price, l_quantity as quantity,
               l_quantity * l_tax * 1000 as pbm_fee, l_shipdate + to_hours(l_linenumber) as filled_at,
               l_returnflag as source_file, 'load-1' as load_id
        from lineitem""",
    "reverts": """
        select 'r' || l_orderkey || '-' || l_linenumber || '-' || l_partkey as revert_id,
               l_orderkey || '-' || l_linenumber as claim_id,
               l_shipdate + to_hours(cast(l_linenumber + l_suppkey % 72 as int)) as reverted_at,
               l_linestatus as source_file, 'load-1' as load_id
        from lineitem where l_returnflag = 'R'""",
    "lookups": """
        select cast(o_orderkey as varchar) as lookup_id,
               case when o_orderstatus <> 'P'
                    then (o_orderkey - o_orderkey % 2) || '-' || (1 + (o_orderkey - o_orderkey % 2) % 7) end as claim_id,
               cast(o_orderkey % 2100 as varchar) as ndc, c_mktsegment as partner,
               case when o_orderpriority = '4-NOT SPECIFIED' then ' ' else ' ' || o_orderpriority end as channel,
               o_orderdate as looked_up_at, o_orderstatus as source_file, 'load-1' as load_id
        from orders join customer on o_custkey = c_custkey""",
    "pharmacies": """
        select cast(s_suppkey as varchar) as npi, ' ' || r_name as chain, 'load-1' as load_id
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        where s_acctbal >= 0""",
    "terms": """
        select * from (values ('AUTOMOBILE', 100.0::double, null::double), ('BUILDING', null, 50.0),
            ('FURNITURE', 0.0, null), ('HOUSEHOLD', null, 80.0), ('MACHINERY', 25.0, 10.0))
            as v(partner, fee_cents, fee_percentage)""",
    "partners": """
        select partner, fee_cents, fee_percentage, 'load-1' as load_id from terms
        where partner in (select c_mktsegment from customer)""",
    "quarters": """
        select distinct cast(date_trunc('quarter', o_orderdate) as date) as as_of_date
        from orders where o_orderdate >= timestamp '1996-01-01'""",
    "nadac": """
        select cast(p_partkey as varchar) as ndc, p_name as ndc_description,
               p_retailprice * (year(as_of_date) - 1985) / 100 as nadac_per_unit,
               as_of_date as effective_date, as_of_date, 'EA' as pricing_unit,
               case when p_type in ('STANDARD', 'ECONOMY', 'PROMO') then 'G' else 'B' end as rate_setting_class,
               p_size < 10 as is_otc, 'load-1' as load_id
        from part, quarters where p_partkey % 17 <> 0""",
    # bronze
    "brz_claims": """
        select claim_id, npi, ndc, price, quantity, pbm_fee, filled_at, cast(filled_at as date) as filled_date,
               pbm_fee > price as flag_fee_exceeds_price, n > 1 as flag_duplicate_claim_id,
               n as claim_id_occurrences, source_file, load_id
        from claims join (select claim_id, count(*) as n from claims group by claim_id) using (claim_id)""",
    "brz_lookups": """
        select lookup_id, claim_id, ndc, partner, channel as channel_raw,
               case when trim(channel) = '' then 'unknown' else lower(trim(channel)) end as channel,
               claim_id is not null as flag_converted, trim(channel) = '' as flag_missing_channel,
               looked_up_at, cast(looked_up_at as date) as looked_up_date, source_file, load_id
        from lookups""",
    "brz_reverts": """
        select revert_id, claim_id, reverted_at, cast(reverted_at as date) as reverted_date,
               count(*) over same_claim > 1 as flag_multiple_reverts,
               row_number() over (same_claim order by reverted_at, revert_id) as revert_sequence,
               source_file, load_id
        from reverts window same_claim as (partition by claim_id)""",
    "brz_nadac": """
        select ndc, ndc_description, nadac_per_unit, effective_date, as_of_date, pricing_unit, rate_setting_class,
               rate_setting_class = 'G' as is_generic, is_otc, load_id
        from nadac where as_of_date is not null""",
    "brz_partners": """
        select partner, fee_cents, fee_percentage,
               fee_cents + fee_percentage is not null as flag_both_fee_terms,
               coalesce(fee_cents, fee_percentage) is null as flag_no_fee_terms, load_id
        from partners""",
    "brz_pharmacies": "select npi, lower(trim(chain)) as chain, load_id from pharmacies",
    # silver
    "slv_pharmacies": "select npi, chain from brz_pharmacies",
    "slv_partners": """
        select partner, fee_cents, fee_percentage,
               case when fee_cents is not null then 'flat' when fee_percentage is not null then 'percentage'
                    else 'undefined' end as fee_type
        from brz_partners where not flag_both_fee_terms""",
    "slv_nadac": """
        select distinct on (ndc, as_of_date) ndc, ndc_description, nadac_per_unit, effective_date, as_of_date,
               pricing_unit, rate_setting_class, is_generic, is_otc
        from brz_nadac order by ndc, as_of_date, effective_date desc nulls last, nadac_per_unit desc nulls last""",
    "unique_claims": "select * from brz_claims where claim_id_occurrences = 1",
    "earliest_claims": """
        select distinct on (claim_id) * from brz_claims order by claim_id, filled_at, source_file, ndc, npi""",
    "slv_claims": """
        select claim_id, npi, chain, ndc, price, quantity, pbm_fee, filled_at, filled_date, flag_fee_exceeds_price,
               source_file
        from unique_claims join slv_pharmacies using (npi)""",
    "slv_claims_earliest": """
        select claim_id, npi, chain, ndc, price, quantity, pbm_fee, filled_at, filled_date, flag_fee_exceeds_price,
               source_file
        from earliest_claims join slv_pharmacies using (npi)""",
    "slv_lookups": """
        select lookup_id, claim_id, ndc, partner, channel, channel_raw, looked_up_at, looked_up_date, flag_converted,
               partner not in (select partner from slv_partners) as flag_unknown_partner
        from brz_lookups""",
    "slv_reverts": """
        select revert_id, claim_id, reverted_at, reverted_date, flag_multiple_reverts from brz_reverts
        where revert_sequence = 1 and claim_id in (select claim_id from slv_claims)""",
    "slv_claim_costs": """
        select c.*, n.nadac_per_unit, n.as_of_date as cost_as_of_date, n.pricing_unit, n.is_generic,
               n.nadac_per_unit is null as flag_cost_unavailable
        from slv_claims c asof left join slv_nadac n on n.ndc = c.ndc and n.as_of_date <= c.filled_date""",
    "newest_prices": "select distinct on (ndc) * from slv_nadac order by ndc, as_of_date desc",
    "slv_claim_costs_latest": """
        select c.*, n.nadac_per_unit, n.as_of_date as cost_as_of_date, n.pricing_unit, n.is_generic,
               n.nadac_per_unit is null as flag_cost_unavailable
        from slv_claims c left join newest_prices n using (ndc)""",
    "converting": """
        select distinct on (claim_id) claim_id, partner, channel, looked_up_at from slv_lookups
        where claim_id is not null order by claim_id, looked_up_at, lookup_id""",
    "attributed": """
        select c.*, l.partner, l.channel, l.looked_up_at, p.fee_cents, p.fee_percentage, p.fee_type,
               r.revert_id, r.reverted_at
        from slv_claim_costs c left join converting l using (claim_id) left join slv_partners p using (partner)
             left join slv_reverts r using (claim_id)""",
    "priced": """
        select *, revert_id is not null as is_reverted, nadac_per_unit * quantity as drug_cost,
               case when quantity <> 0 then price / quantity end as unit_price,
               case when fee_type = 'flat' then least(fee_cents / 100, pbm_fee)
                    when fee_type = 'percentage' then pbm_fee * (fee_percentage / 100) else 0 end as partner_fee
        from attributed""",
    "slv_claim_economics": """
        select claim_id, npi, chain, ndc, partner, channel, fee_type, filled_at, filled_date, looked_up_at,
               is_reverted, reverted_at, date_diff('hour', filled_at, reverted_at) as hours_to_revert, price, quantity,
               unit_price, pbm_fee, drug_cost, nadac_per_unit, cost_as_of_date, partner_fee,
               pbm_fee - partner_fee as retained_margin, price - drug_cost - pbm_fee as pharmacy_margin, is_generic,
               flag_cost_unavailable, flag_fee_exceeds_price
        from priced""",
    # gold
    "fct_claim": """
        select claim_id, npi, ndc, partner, filled_date as date_day, chain, channel, fee_type, filled_at, is_reverted,
               reverted_at, hours_to_revert, looked_up_at,
               date_diff('minute', looked_up_at, filled_at) as minutes_lookup_to_fill,
               price, quantity, unit_price, pbm_fee, partner_fee, retained_margin, pharmacy_margin, drug_cost,
               nadac_per_unit,
               case when is_reverted then 0 else price end as net_revenue,
               case when is_reverted then 0 else quantity end as net_quantity,
               case when is_reverted then 0 else pbm_fee end as net_pbm_fee,
               case when is_reverted then 0 else partner_fee end as net_partner_fee,
               case when is_reverted then 0 else retained_margin end as net_retained_margin,
               case when is_reverted then 0 else pharmacy_margin end as net_pharmacy_margin,
               case when is_reverted then 0 else drug_cost end as net_drug_cost,
               case when is_reverted then 0 else 1 end as net_fills,
               is_generic, cost_as_of_date, flag_cost_unavailable, flag_fee_exceeds_price
        from slv_claim_economics""",
    "fct_lookup": """
        select l.lookup_id, l.claim_id, l.ndc, l.partner, l.channel, l.looked_up_date as date_day, l.looked_up_at,
               l.flag_converted as converted, c.claim_id is not null as converted_to_valid_claim,
               l.flag_unknown_partner, c.chain, c.is_reverted, c.net_revenue, c.net_pbm_fee, c.net_retained_margin,
               date_diff('minute', l.looked_up_at, c.filled_at) as minutes_to_fill
        from slv_lookups l left join fct_claim c on c.claim_id = l.claim_id""",
    "days": """
        select unnest(generate_series(min(d), max(d), interval 1 day))::date as date_day
        from (select filled_date as d from slv_claims union all select looked_up_date from slv_lookups)""",
    "dim_date": """
        select date_day, year(date_day)::int as year, quarter(date_day)::int as quarter, month(date_day)::int as month,
               strftime(date_day, '%B') as month_name, date_trunc('month', date_day)::date as month_start,
               date_trunc('week', date_day)::date as week_start, dayofweek(date_day)::int as day_of_week,
               strftime(date_day, '%A') as day_name, dayofweek(date_day) in (0, 6) as is_weekend
        from days""",
    "codes": "select ndc from slv_claims union select ndc from slv_lookups",
    "dim_drug": """
        select ndc, ndc_description, pricing_unit, rate_setting_class, is_generic, is_otc,
               ndc not in (select ndc from newest_prices) as is_missing_from_nadac
        from codes left join newest_prices using (ndc)""",
    "dim_partner": "select partner, fee_cents, fee_percentage, fee_type from slv_partners",
    "dim_pharmacy": "select npi, chain from slv_pharmacies",
    # The marts' grain; their values have queries of their own.
    "gld_partner_performance": "select distinct partner, chain, date_trunc('month', date_day) as month_start from fct_claim",
    "gld_conversion_funnel": "select distinct partner, channel, date_trunc('month', date_day) as month_start from fct_lookup",
    "gld_revenue_reconciliation": "select unnest(range(6)) as stage",
    # text records
    "raw_claims": """
        select '{"id":"e' || event_id || '","npi":' || case when event_id % 47 = 0 then 'null' else '"' || user_id || '"' end
               || ',"ndc":"' || event_id % 2000 || '","price":'
               || case when event_id % 41 = 0 then '"n/a"'
                       when event_id % 37 = 0 then '"' || cast(value as decimal(12,2)) || '"'
                       when event_id % 53 = 0 then '-1' || cast(value as decimal(12,2))
                       else cast(cast(value as decimal(12,2)) as varchar) end
               || ',"quantity":' || event_id % 59 || ',"pbm_fee":2.75'
               || case when event_id % 61 = 0 then '' else ',"timestamp":"'
                  || case when event_id % 43 = 0 then 'yesterday' else strftime(ts, '%Y-%m-%dT%H:%M:%S') end || '"' end
               || '}' as raw_payload, event_type as source_file, 'load-1' as load_id
        from events""",
    "raw_reverts": """
        select '{"id":"r' || event_id || '","claim_id":'
               || case when event_id % 29 = 0 then 'null' else '"e' || event_id || '"' end
               || case when event_id % 61 = 0 then '' else ',"timestamp":"'
                  || case when event_id % 43 = 0 then 'yesterday' else strftime(ts, '%Y-%m-%dT%H:%M:%S') end || '"' end
               || '}' as raw_payload, event_type as source_file, 'load-1' as load_id
        from events""",
    "raw_lookups": """
        select '{"id":"l' || event_id || '"'
               || case when event_id % 3 = 0 then '' when event_id % 5 = 0 then ',"claim_id":"' || event_id || '"'
                       else ',"claim_id":null' end
               || ',"ndc":' || event_id % 2000
               || case when event_id % 31 = 0 then '' else ',"partner":"' || event_type || '"' end
               || ',"channel":' || case when event_id % 7 = 0 then '""' else '"website"' end
               || case when event_id % 61 = 0 then '' else ',"timestamp":"'
                  || case when event_id % 43 = 0 then 'yesterday' else strftime(ts, '%Y-%m-%dT%H:%M:%S') end || '"' end
               || '}' as raw_payload, event_type as source_file, 'load-1' as load_id
        from events""",
    "judged_claims": f"""
        with fields as (
            select *, {_pick('id')} as claim_id, {_pick('npi')} as npi, {_pick('ndc')} as ndc,
                   {_number(_pick('price'))} as price, {_number(_pick('quantity'))} as quantity,
                   {_number(_pick('pbm_fee'))} as pbm_fee, try_cast({_pick('timestamp')} as timestamp) as filled_at
            from raw_claims),
        absent as (
            select *, concat_ws(',', case when npi is null then 'npi' end,
                                case when {_pick('timestamp')} is null then 'timestamp' end) as missing
            from fields)
        select claim_id, npi, ndc, price, quantity, pbm_fee, filled_at, source_file, load_id, raw_payload,
               case when missing <> '' then 'missing_required_field:' || missing
                    when filled_at is null then 'unparseable_timestamp'
                    when price is null then 'non_numeric:price'
                    when price < 0 then 'negative_price'
                    when quantity <= 0 then 'non_positive_quantity' end as reject_reason
        from absent""",
    "judged_reverts": f"""
        select {_pick('id')} as revert_id, {_pick('claim_id')} as claim_id,
               try_cast({_pick('timestamp')} as timestamp) as reverted_at, source_file, load_id, raw_payload,
               case when {_pick('claim_id')} is null and {_pick('timestamp')} is null
                        then 'missing_required_field:claim_id,timestamp'
                    when {_pick('claim_id')} is null then 'missing_required_field:claim_id'
                    when {_pick('timestamp')} is null then 'missing_required_field:timestamp'
                    when try_cast({_pick('timestamp')} as timestamp) is null then 'unparseable_timestamp'
               end as reject_reason
        from raw_reverts""",
    "judged_lookups": f"""
        select {_pick('id')} as lookup_id, {_pick('claim_id')} as claim_id, {_pick('ndc')} as ndc,
               {_pick('partner')} as partner, {_pick('channel')} as channel,
               try_cast({_pick('timestamp')} as timestamp) as looked_up_at, source_file, load_id, raw_payload,
               case when {_pick('partner')} is null and {_pick('timestamp')} is null
                        then 'missing_required_field:partner,timestamp'
                    when {_pick('partner')} is null then 'missing_required_field:partner'
                    when {_pick('timestamp')} is null then 'missing_required_field:timestamp'
                    when try_cast({_pick('timestamp')} as timestamp) is null then 'unparseable_timestamp'
               end as reject_reason
        from raw_lookups""",
    "brz_rejects": """
        select 'claims' as stream, reject_reason, raw_payload, source_file, load_id from judged_claims
        where reject_reason is not null
        union all
        select 'reverts', reject_reason, raw_payload, source_file, load_id from judged_reverts
        where reject_reason is not null
        union all
        select 'lookups', reject_reason, raw_payload, source_file, load_id from judged_lookups
        where reject_reason is not null""",
}


def statement(query: str) -> str:
    """The query with the definitions of all tables it needs, directly or not."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\w+", text)) & set(TABLES) - needed:
            needed.add(name)
            visit(TABLES[name])

    visit(query)
    if not needed:
        return query
    definitions = ",\n".join(f"{name} as ({TABLES[name]})" for name in TABLES if name in needed)
    own = re.sub(r"^\s*with\s", "", query)
    return f"with {definitions}{',' if own != query else ''}\n{own}"
