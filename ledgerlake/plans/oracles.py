"""Independent SQL for each registered query, over the same tables."""

from __future__ import annotations

from ledgerlake.plans.fixtures import DAY, OPENED
from ledgerlake.plans.registry import AFTER, BEFORE, HIGH, LARGE, LAST

_CTES = {
    "f_customer": """
        select concat('CUST', lpad(cast(c_custkey as varchar), 8, '0')) as customer_id, c_name as cust_name,
               case when c_custkey % 2 = 0 then 'PERSONAL' else 'CORPORATE' end as cust_type,
               c_mktsegment as cust_level, n_name as nationality,
               cast(c_acctbal as decimal(18,2)) as annual_income,
               case c_custkey % 3 when 0 then 'F' when 1 then 'M' end as gender,
               date '1950-01-01' + cast(c_custkey % 18000 as integer) as birth_date,
               date '2010-01-01' + cast(c_custkey % 4000 as integer) as open_date,
               date '2010-01-02' + cast(c_custkey % 4000 as integer) as create_date,
               make_timestamp((1600000000 + c_custkey) * 1000000) as update_time
        from customer join nation on c_nationkey = n_nationkey""",
    "f_account": """
        select concat('6222', lpad(cast(o_orderkey as varchar), 14, '0')) as account_no,
               concat('CUST', lpad(cast(o_custkey as varchar), 8, '0')) as customer_id,
               o_orderpriority as acct_type, case when o_orderkey % 20 = 0 then 'USD' else 'CNY' end as currency, cast(o_orderdate as date) as open_date,
               case o_orderstatus when 'O' then 'NORMAL' when 'F' then 'FROZEN' else 'DORMANT' end as status,
               concat('ORG', cast(c_nationkey as varchar)) as branch_id,
               concat('PROD_', o_orderpriority) as product_id
        from orders join customer on o_custkey = c_custkey""",
    "f_balance": """
        select account_no, balance,
               case when o_orderpriority in ('1-URGENT', '2-HIGH') then 0 else balance end as avail_balance,
               case when o_orderpriority = '1-URGENT' then balance else 0 end as frozen_amt, last_update
        from (select concat('6222', lpad(cast(o_orderkey as varchar), 14, '0')) as account_no, o_orderpriority,
                     cast(case when o_orderstatus = 'O' then o_totalprice else 0 end as decimal(18,2)) as balance,
                     o_orderdate as last_update
              from orders) x""",
    "f_txn": """
        select concat('TXN', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as trans_id,
               concat('6222', lpad(cast(l_orderkey as varchar), 14, '0')) as account_no,
               l_returnflag as trans_type, cast(l_extendedprice as decimal(18,2)) as trans_amt,
               case when l_linestatus = 'O' then 'C' else 'D' end as dr_cr_flag, l_shipdate as trans_time,
               case l_returnflag when 'A' then 'ALIPAY' when 'R' then 'UNIONPAY' else 'ATM' end as channel
        from lineitem""",
    "f_event": """
        select concat('EVT', lpad(cast(event_id as varchar), 10, '0')) as trans_id,
               concat('6222', lpad(cast(user_id as varchar), 14, '0')) as account_no,
               event_type as trans_type, cast(value as decimal(18,2)) as trans_amt,
               case when event_type in ('signup', 'click') then 'C' else 'D' end as dr_cr_flag, ts as trans_time,
               case user_id % 4 when 0 then 'ALIPAY' when 1 then 'WECHAT_PAY' when 2 then 'ATM'
                    else 'COUNTER_HIGH' end as channel
        from events""",
    "f_pay": """
        select concat('PAY', lpad(cast(event_id as varchar), 10, '0')) as pay_id,
               cast(value as decimal(18,2)) as amount,
               case event_type when 'error' then 'FAILED' when 'signup' then 'PENDING' else 'SUCCESS' end as pay_status,
               ts as create_time
        from events""",
    "f_loan": """
        select concat('LOAN', lpad(cast(s_suppkey as varchar), 8, '0')) as contract_no,
               concat('CUST', lpad(cast(s_suppkey as varchar), 8, '0')) as customer_id,
               cast(s_acctbal as decimal(18,2)) as loan_amt, (s_suppkey % 9 + 1) / 100.0 as rate,
               cast(s_suppkey % 36 + 6 as integer) as term,
               date '2022-01-01' + cast(s_suppkey % 700 as integer) as sign_date,
               date '2022-01-08' + cast(s_suppkey % 700 as integer) as start_date,
               date '2025-01-08' + cast(s_suppkey % 700 as integer) as end_date,
               case when s_suppkey % 4 = 0 then 'SETTLED' else 'ACTIVE' end as status
        from supplier""",
    "f_card": """
        select concat('6228', lpad(cast(c_custkey as varchar), 14, '0')) as card_no,
               concat('CUST', lpad(cast(c_custkey as varchar), 8, '0')) as customer_id, c_mktsegment as card_level,
               cast(abs(c_acctbal) as decimal(18,2)) as credit_limit,
               date '2018-01-01' + cast(c_custkey % 2000 as integer) as open_date,
               date '2028-01-01' + cast(c_custkey % 2000 as integer) as expire_date
        from customer""",
    "f_ebank": """
        select concat('EBK', lpad(cast(event_id as varchar), 10, '0')) as trans_id,
               concat('CUST', lpad(cast(user_id as varchar), 8, '0')) as customer_id, event_type as trans_type,
               cast(value as decimal(18,2)) as amount, ts as trans_time
        from events""",
    "summary": """
        select l.customer_hash_key, coalesce(sum(b.balance), 0) as total, count(distinct l.account_hash_key) as accounts
        from (select md5('CORE|' || customer_id || '|HUB_CUSTOMER') as customer_hash_key,
                     md5('CORE|' || account_no || '|HUB_ACCOUNT') as account_hash_key from f_account) l
        join (select md5('CORE|' || b.account_no || '|HUB_ACCOUNT') as account_hash_key, b.balance
              from f_balance b join f_account a on a.account_no = b.account_no) b
          on b.account_hash_key = l.account_hash_key
        group by 1""",
    "kpi": """
        select 'TOTAL_CUSTOMER' as kpi_code, '总客户数' as kpi_name, 'CUSTOMER' as kpi_category,
               cast(count(distinct customer_id) as decimal(18,4)) as kpi_value, 'COUNT' as kpi_unit from f_customer
        union all select 'TOTAL_DEPOSIT', '存款余额', 'DEPOSIT', cast(coalesce(sum(balance), 0) as decimal(18,4)), 'YUAN'
                  from f_balance where account_no in (select account_no from f_account)
        union all select 'TOTAL_ACCOUNT', '账户总数', 'DEPOSIT', cast(count(distinct account_no) as decimal(18,4)), 'COUNT'
                  from f_account
        union all select 'DAILY_TXN_CNT', '当日交易笔数', 'PAYMENT', cast(count(distinct trans_id) as decimal(18,4)), 'COUNT'
                  from f_txn
        union all select 'DAILY_TXN_AMT', '当日交易金额', 'PAYMENT', cast(coalesce(sum(trans_amt), 0) as decimal(18,4)), 'YUAN'
                  from f_txn
        union all select 'TOTAL_LOAN', '贷款合同数', 'LOAN', cast(count(distinct contract_no) as decimal(18,4)), 'COUNT'
                  from f_loan
        union all select 'TOTAL_CC', '信用卡发卡量', 'CREDIT_CARD', cast(count(distinct card_no) as decimal(18,4)), 'COUNT'
                  from f_card""",
    "d_kpi": """
        select cast(d as varchar) as dt, 'DAILY_TXN_CNT' as kpi_code, cast(count(distinct trans_id) as double) as kpi_value
        from (select cast(trans_time as date) as d, trans_id from f_txn) a group by 1
        union all
        select cast(d as varchar), 'DAILY_TXN_AMT', cast(sum(trans_amt) as double)
        from (select cast(trans_time as date) as d, trans_amt from f_txn) b group by 1""",
}

# which building blocks a block needs
_NEEDS = {
    "summary": ("f_account", "f_balance"),
    "kpi": ("f_customer", "f_account", "f_balance", "f_txn", "f_loan", "f_card"),
    "d_kpi": ("f_txn",),
}


def _live(dt: str) -> str:
    return f"cast(o_orderdate as date) < date '{OPENED[1]}'" if dt == BEFORE else f"cast(o_orderdate as date) >= date '{OPENED[0]}'"


def _customer_day(dt: str) -> str:
    return f"""
        select customer_hash_key, cust_name, cust_level, status, date '{dt}' as load_date,
               md5(concat_ws('|', cust_name, '', '', '', '', cust_level, '', status)) as hash_diff
        from (select md5('CORE|CUST' || lpad(cast(c_custkey as varchar), 8, '0') || '|HUB_CUSTOMER') as customer_hash_key,
                     c_name as cust_name, o_orderpriority as cust_level, o_orderstatus as status,
                     row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n
              from orders join customer on o_custkey = c_custkey where {_live(dt)}) x
        where n = 1"""


def _link_day(dt: str) -> str:
    return f"""
        select md5(ck || '|' || ak || '|PRIMARY|LINK_CUST_ACCT') as lk, ck, ak, open_date, date '{dt}' as load_date
        from (select md5('CORE|CUST' || lpad(cast(o_custkey as varchar), 8, '0') || '|HUB_CUSTOMER') as ck,
                     md5('CORE|6222' || lpad(cast(o_orderkey as varchar), 14, '0') || '|HUB_ACCOUNT') as ak,
                     cast(o_orderdate as date) as open_date
              from orders where {_live(dt)}) x"""


_CTES["before_day"] = _customer_day(BEFORE)
_CTES["after_day"] = _customer_day(AFTER)
_CTES["before_link"] = _link_day(BEFORE)
_CTES["after_link"] = _link_day(AFTER)
_CTES["versions"] = f"""
        select b.*, date '9999-12-31' as load_end_date, true as is_current
        from before_day b join after_day a using (customer_hash_key) where a.hash_diff = b.hash_diff
        union all
        select b.*, date '{AFTER}', false
        from before_day b left join after_day a using (customer_hash_key)
        where a.hash_diff is null or a.hash_diff <> b.hash_diff
        union all
        select a.*, date '9999-12-31', true
        from after_day a left join before_day b using (customer_hash_key)
        where b.hash_diff is null or a.hash_diff <> b.hash_diff"""
_CTES["changes"] = """
        select concat('ACCT', cast(user_id as varchar)) as trans_id,
               case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op,
               concat('6222', lpad(cast(user_id as varchar), 14, '0')) as account_no, event_type as trans_type,
               cast(value as decimal(18,2)) as trans_amt, date_trunc('second', ts) as trans_time,
               case user_id % 4 when 0 then 'ALIPAY' when 1 then 'WECHAT_PAY' when 2 then 'ATM'
                    else 'COUNTER_HIGH' end as channel,
               row_number() over (partition by user_id order by epoch_ms(ts) desc, event_id desc) as n
        from events"""
_NEEDS["versions"] = ("before_day", "after_day")


def _with(blocks: str, body: str) -> str:
    """``body`` after the named building blocks and what they need."""
    names: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in names:
            names.append(name)

    for block in blocks.split():
        add(block)
    if not names:
        return body
    return "with " + ",\n".join(f"{n} as ({_CTES[n]})" for n in names) + "\n" + body


def _hub(block: str, tag: str, column: str, hub: str, key: str, out: str) -> str:
    return _with(
        block,
        f"""select distinct md5('{tag}|' || {column} || '|{hub}') as {key}, {column} as {out},
                   '{DAY}' as load_date, '{tag}' as record_source
            from {block} where {column} is not null""",
    )


_TXN_KEY = "md5('CORE|' || trans_id || '|HUB_TRANSACTION')"
_NIGHT = "(hour(trans_time) >= 22 or hour(trans_time) < 6)"
_BAND = """case when total >= 10000000 then '1000万+' when total >= 5000000 then '500-1000万'
                when total >= 1000000 then '100-500万' when total >= 500000 then '50-100万'
                when total >= 100000 then '10-50万' when total >= 10000 then '1-10万' else '1万以下' end"""
_STAMP = "'batch_" + DAY.replace("-", "") + "' as batch_id"
_NO = "cast(null as varchar)"


def _nulls(names: str) -> str:
    return ", ".join(f"{_NO} as {n}" for n in names.split())


def _key_rules(block: str, table: str, key: str) -> str:
    return f"""
        select 'null_key' as rule, '{table}' as table_name,
               cast(sum(case when {key} is null then 1 else 0 end) as bigint) as failed, count(*) as total from {block}
        union all
        select 'duplicate_key', '{table}', cast(count({key}) - count(distinct {key}) as bigint), count(*) from {block}"""


_TOP = f"""
    select c.cust_name, s.total, s.customer_hash_key
    from summary s join (select md5('CORE|' || customer_id || '|HUB_CUSTOMER') as customer_hash_key, cust_name
                         from f_customer) c on c.customer_hash_key = s.customer_hash_key
    order by s.total desc, s.customer_hash_key, c.cust_name"""

_ALL_SOURCES = "f_customer f_account f_balance f_txn f_pay f_loan f_card f_ebank"

_COUNTED = {
    "ods_customer": "f_customer", "ods_account": "f_account", "ods_balance": "f_balance", "ods_transaction": "f_txn",
    "ods_payment": "f_pay", "ods_loan": "f_loan", "ods_card": "f_card", "ods_ebank": "f_ebank",
    "hub_customer": "(select distinct customer_id from f_customer)",
    "hub_account": "(select distinct account_no from f_account)",
    "hub_transaction": "(select distinct trans_id from f_txn)",
    "hub_loan": "(select distinct contract_no from f_loan)",
    "hub_card": "(select distinct card_no from f_card)",
    "hub_product": "(select distinct product_id from f_account)",
    "hub_org": "(select distinct branch_id from f_account)",
    "sat_customer": "f_customer",
    "sat_balance": "(select 1 from f_balance b join f_account a on a.account_no = b.account_no)",
    "sat_transaction": "f_txn",
    "link_cust_acct": "f_account",
    "cust_daily_summary": "summary",
}


def _windows(seconds: int) -> str:
    start = f"time_bucket(interval '{seconds} seconds', trans_time)"
    return f"select strftime({start}, '%Y-%m-%d %H:%M:%S') as window_start, channel, "


def _fast(time: str) -> str:
    """Each large credit with the debits of its account within the day after it."""
    return _with("f_event", f"""
        select c.account_no, cast(c.t as varchar) as in_time, cast(c.trans_amt as double) as in_amt,
               cast(sum(d.trans_amt) as double) as out_amt, cast(max(d.t) as varchar) as last_out, 'FAST_IN_OUT' as alert_type
        from (select *, {time} as t from f_event where dr_cr_flag = 'C' and trans_amt >= 20) c
        join (select *, {time} as t from f_event where dr_cr_flag = 'D') d
          on d.account_no = c.account_no and d.t > c.t and d.t <= c.t + interval 1 day
        group by c.trans_id, c.account_no, c.t, c.trans_amt
        having sum(d.trans_amt) >= c.trans_amt * 0.5""")


# block and key of each source
_LOADED = {
    "customer": ("f_customer", "customer_id"), "account": ("f_account", "account_no"), "balance": ("f_balance", "account_no"),
    "transaction": ("f_txn", "trans_id"), "payment": ("f_pay", "pay_id"), "loan": ("f_loan", "contract_no"),
    "card": ("f_card", "card_no"), "ebank": ("f_ebank", "trans_id"),
}

ORACLES: dict[str, str] = {
    "hub_customer": _hub("f_customer", "CORE", "customer_id", "HUB_CUSTOMER", "customer_hash_key", "customer_id"),
    "hub_account": _hub("f_account", "CORE", "account_no", "HUB_ACCOUNT", "account_hash_key", "account_no"),
    "hub_transaction": _hub("f_txn", "CORE", "trans_id", "HUB_TRANSACTION", "transaction_hash_key", "trans_id"),
    "hub_loan": _hub("f_loan", "LOAN", "contract_no", "HUB_LOAN_CONTRACT", "contract_hash_key", "contract_no"),
    "hub_card": _hub("f_card", "CC", "card_no", "HUB_CC_CARD", "card_hash_key", "card_no"),
    "hub_product": _hub("f_account", "CORE", "product_id", "HUB_PRODUCT", "product_hash_key", "product_id"),
    "hub_org": _hub("f_account", "CORE", "branch_id", "HUB_ORG", "org_hash_key", "org_id"),
    "sat_customer": _with("f_customer", f"""
        select md5('CORE|' || customer_id || '|HUB_CUSTOMER') as customer_hash_key, '{DAY}' as load_date,
               '9999-12-31' as load_end_date, true as is_current, cust_name,
               {_nulls("id_type id_no mobile phone email address occupation education status")},
               gender, cast(birth_date as varchar) as birth_date, cast(open_date as varchar) as open_date,
               cust_type, cust_level, nationality, cast(annual_income as double) as annual_income,
               'CORE' as record_source,
               md5(concat_ws('|', cust_name, '', '', '', cust_type, cust_level, coalesce(gender, ''), '')) as hash_diff
        from f_customer"""),
    "sat_balance": _with("f_balance f_account", f"""
        select md5('CORE|' || b.account_no || '|HUB_ACCOUNT') as account_hash_key, '{DAY}' as load_date,
               cast(b.balance as double) as balance, cast(b.avail_balance as double) as avail_balance,
               cast(b.frozen_amt as double) as frozen_amt, a.currency,
               cast(b.last_update as varchar) as last_txn_time, 'CORE' as record_source
        from f_balance b join f_account a on a.account_no = b.account_no"""),
    "sat_transaction": _with("f_txn", f"""
        select {_TXN_KEY} as transaction_hash_key, '{DAY}' as load_date,
               cast(cast(trans_time as date) as varchar) as trans_date, cast(trans_time as varchar) as trans_time,
               trans_type, cast(trans_amt as double) as trans_amt, 'CNY' as currency, dr_cr_flag,
               {_nulls("from_account_no to_account_no teller_id opp_account_no memo")}, channel,
               'SUCCESS' as trans_status, channel in ('ALIPAY', 'WECHAT_PAY', 'UNIONPAY') as is_cross_bank,
               'CORE' as record_source
        from f_txn"""),
    "link_cust_acct": _with("f_account", f"""
        select md5(customer_hash_key || '|' || account_hash_key || '|PRIMARY|LINK_CUST_ACCT') as cust_acct_hash_key,
               customer_hash_key, account_hash_key, 'PRIMARY' as rel_type, cast(open_date as varchar) as rel_start_date,
               {_NO} as rel_end_date, true as is_active, '{DAY}' as load_date, 'CORE' as record_source
        from (select md5('CORE|' || customer_id || '|HUB_CUSTOMER') as customer_hash_key,
                     md5('CORE|' || account_no || '|HUB_ACCOUNT') as account_hash_key, open_date from f_account) x"""),
    "link_cust_loan": _with("f_loan", f"""
        select md5(customer_hash_key || '|' || contract_hash_key || '|BORROWER|LINK_CUST_LOAN') as cust_loan_hash_key,
               customer_hash_key, contract_hash_key, 'BORROWER' as rel_type, cast(start_date as varchar) as rel_start_date,
               cast(end_date as varchar) as rel_end_date,
               true as is_active, '{DAY}' as load_date, 'LOAN' as record_source
        from (select md5('CORE|' || customer_id || '|HUB_CUSTOMER') as customer_hash_key,
                     md5('LOAN|' || contract_no || '|HUB_LOAN_CONTRACT') as contract_hash_key, start_date, end_date from f_loan) x"""),
    "link_txn_acct": _with("f_txn", f"""
        select md5(transaction_hash_key || '|' || account_hash_key || '|BOOKED|LINK_TXN_ACCT') as txn_acct_hash_key,
               transaction_hash_key, account_hash_key, 'BOOKED' as rel_type, '{DAY}' as load_date,
               'CORE' as record_source
        from (select distinct {_TXN_KEY} as transaction_hash_key,
                     md5('CORE|' || account_no || '|HUB_ACCOUNT') as account_hash_key from f_txn) x"""),
    "cust_daily_summary": _with("summary", """
        select customer_hash_key, cast(total as double) as total_asset_amt, cast(total as double) as deposit_amt,
               cast(0 as double) as loan_amt, cast(0 as bigint) as daily_txn_cnt, cast(0 as double) as daily_txn_amt,
               cast(accounts as integer) as account_cnt, cast(1 as integer) as product_holding_cnt
        from summary"""),
    "cust_daily_summary_extended": _with("summary f_txn f_loan", """
        , l as (select md5('CORE|' || customer_id || '|HUB_CUSTOMER') as k, sum(loan_amt) as amt from f_loan where status = 'ACTIVE' group by 1),
        t as (select md5('CORE|' || a.customer_id || '|HUB_CUSTOMER') as k, count(*) as n, sum(trans_amt) as amt
              from f_txn x join f_account a on a.account_no = x.account_no group by 1),
        p as (select md5('CORE|' || customer_id || '|HUB_CUSTOMER') as k, count(distinct product_id) as n
              from f_account group by 1)
        select customer_hash_key, cast(total as double) as total_asset_amt, cast(total as double) as deposit_amt,
               cast(coalesce(l.amt, 0) as double) as loan_amt, cast(coalesce(t.n, 0) as bigint) as daily_txn_cnt,
               cast(coalesce(t.amt, 0) as double) as daily_txn_amt, cast(accounts as integer) as account_cnt,
               cast(coalesce(p.n, 0) as integer) as product_holding_cnt
        from summary s left join l on l.k = s.customer_hash_key left join t on t.k = s.customer_hash_key
             left join p on p.k = s.customer_hash_key"""),
    "mgmt_kpi": _with("kpi", """
        select kpi_code, kpi_name, kpi_category, cast(kpi_value as double) as kpi_value, kpi_unit,
               cast(0 as double) as yoy_change, cast(0 as double) as mom_change from kpi"""),
    "kpi_list": _with("kpi", """
        select kpi_code, kpi_name, cast(cast(kpi_value as decimal(18,2)) as double) as kpi_value, kpi_unit
        from kpi order by kpi_code"""),
    "kpi_text": _with("kpi", """
        select kpi_code, kpi_name, cast(kpi_value as varchar) as kpi_value, kpi_unit from kpi order by kpi_code"""),
    "kpi_cards": _with("kpi", """
        select kpi_code, format('{:,.0f}', v) as number_text, format('{:,.2f}亿', v / 1e8) as yi_text,
               format('{:,.2f}万', v / 1e4) as wan_text,
               case when v >= 1e8 then format('{:.2f} 亿', v / 1e8)
                    when v >= 1e4 then concat(cast(cast(floor(v / 1e4 + 0.5) as bigint) as varchar), ' 万')
                    else format('{:,.0f}', floor(v + 0.5)) end as auto_text
        from (select kpi_code, cast(kpi_value as double) as v from kpi) x order by kpi_code"""),
    "kpi_change": _with("d_kpi", """
        select k.dt, k.kpi_code,
               case k.kpi_code when 'DAILY_TXN_CNT' then '当日交易笔数' else '当日交易金额' end as kpi_name,
               'PAYMENT' as kpi_category, k.kpi_value,
               case k.kpi_code when 'DAILY_TXN_CNT' then 'COUNT' else 'YUAN' end as kpi_unit,
               cast(cast((k.kpi_value - y.kpi_value) / nullif(y.kpi_value, 0) * 100 as decimal(18,2)) as double) as yoy_change,
               cast(cast((k.kpi_value - m.kpi_value) / nullif(m.kpi_value, 0) * 100 as decimal(18,2)) as double) as mom_change
        from d_kpi k
        left join d_kpi y on y.kpi_code = k.kpi_code and y.dt = cast(cast(cast(k.dt as date) - interval 12 month as date) as varchar)
        left join d_kpi m on m.kpi_code = k.kpi_code and m.dt = cast(cast(cast(k.dt as date) - interval 1 month as date) as varchar)
        """),
    "aum_distribution": _with("summary", f"""
        select bucket, cnt from (select {_BAND} as bucket, count(*) as cnt, min(total) as lowest from summary group by 1) x
        order by lowest"""),
    "hourly_trend": _with("f_event", """
        select cast(hour(trans_time) as integer) as "hour", count(*) as cnt, cast(sum(trans_amt) as double) as amt
        from f_event group by 1 order by 1"""),
    "hourly_counts": _with("f_event", """
        select cast(hour(trans_time) as integer) as "hour", count(*) as cnt from f_event group by 1 order by 1"""),
    "channel_distribution": _with("f_event", """
        select channel, count(*) as cnt, cast(sum(trans_amt) as double) as amt from f_event
        group by channel order by cnt desc, channel"""),
    "channel_counts": _with("f_event", """
        select channel, count(*) as cnt from f_event group by channel order by cnt desc, channel limit 6"""),
    "account_types": _with("f_account", """
        select acct_type as type, count(*) as cnt from f_account group by 1 order by cnt desc, type"""),
    "top_customers": _with("summary f_customer", f"""
        select cust_name, cast(total as double) as amt from ({_TOP} limit 15) x"""),
    "masked_top_customers": _with("summary f_customer", f"""
        select concat(substring(cust_name, 1, 3), '**') as name, cast(total as double) as amt,
               round_even(cast(total as double) / 10000, 0) as amt_wan from ({_TOP} limit 20) x"""),
    "transaction_summary": _with("f_txn", """
        select count(*) as total_cnt, cast(sum(trans_amt) as double) as total_amt,
               cast(cast(sum(trans_amt) / count(*) as decimal(18,2)) as double) as avg_amt, count(*) as success_cnt
        from f_txn"""),
    "recent_transactions": _with("f_event", f"""
        select {_TXN_KEY} as transaction_hash_key, cast(cast(trans_time as date) as varchar) as trans_date,
               cast(trans_time as varchar) as trans_time, trans_type, cast(trans_amt as double) as trans_amt, channel,
               'SUCCESS' as trans_status
        from f_event order by f_event.trans_time desc, 1 limit 20"""),
    "risk_overview": _with("f_event", f"""
        select count(*) as total_txn, cast(sum(case when trans_amt > {LARGE} then 1 else 0 end) as bigint) as large_txn_cnt,
               cast(sum(case when trans_amt > {LARGE} then trans_amt else 0 end) as double) as large_txn_amt,
               cast(sum(case when {_NIGHT} then 1 else 0 end) as bigint) as night_txn_cnt,
               cast(99.85 as double) as pass_rate, cast(0.15 as double) as abnormal_rate
        from f_event"""),
    "risk_overview_computed": _with("f_event", f"""
        select total_txn, large_txn_cnt, large_txn_amt, night_txn_cnt,
               round(100.0 - round(large_txn_cnt * 100.0 / total_txn, 4), 4)::double as pass_rate,
               round(large_txn_cnt * 100.0 / total_txn, 4)::double as abnormal_rate
        from (select count(*) as total_txn, cast(sum(case when trans_amt > {LARGE} then 1 else 0 end) as bigint) as large_txn_cnt,
                     cast(sum(case when trans_amt > {LARGE} then trans_amt else 0 end) as double) as large_txn_amt,
                     cast(sum(case when {_NIGHT} then 1 else 0 end) as bigint) as night_txn_cnt
              from f_event) x"""),
    "risk_alerts": _with("f_event", f"""
        select {_TXN_KEY} as transaction_hash_key, cast(trans_time as varchar) as trans_time, trans_type,
               cast(trans_amt as double) as trans_amt, channel,
               case when trans_amt > {HIGH} then 'HIGH' when trans_amt > {LARGE} then 'MEDIUM' else 'LOW' end as risk_level
        from f_event where trans_amt > {LARGE} or {_NIGHT}
        order by f_event.trans_amt desc, 1 limit 10"""),
    "summary_texts": _with("summary", """
        select customer_hash_key, concat(cast(cast(floor(v / 1e4 + 0.5) as bigint) as varchar), ' 万') as wan_text,
               format('{:.2f} 亿', v / 1e8) as yi_text,
               case when v >= 1e8 then format('{:.2f} 亿', v / 1e8)
                    when v >= 1e4 then concat(cast(cast(floor(v / 1e4 + 0.5) as bigint) as varchar), ' 万')
                    else format('{:,.0f}', floor(v + 0.5)) end as auto_text
        from (select customer_hash_key, cast(total as double) as v from summary) x"""),
    "ods_load_customer": _with("f_customer", f"""
        select customer_id, cust_name, {_nulls("id_type id_no mobile phone email address occupation education close_date status")},
               gender, cast(birth_date as varchar) as birth_date, cast(open_date as varchar) as open_date,
               cast(create_date as varchar) as create_date, cast(update_time as varchar) as update_time,
               cust_type, cust_level, nationality, cast(annual_income as double) as annual_income,
               'CORE' as source_system, {_STAMP} from f_customer"""),
    "ods_load_account": _with("f_account", f"""
        select account_no, customer_id, acct_type, currency, cast(open_date as varchar) as open_date, status, branch_id,
               product_id, 'CORE' as source_system, {_STAMP} from f_account"""),
    "ods_load_balance": _with("f_balance", f"""
        select account_no, cast(balance as double) as balance, cast(avail_balance as double) as avail_balance,
               cast(frozen_amt as double) as frozen_amt, cast(last_update as varchar) as last_update,
               'CORE' as source_system, {_STAMP} from f_balance"""),
    "ods_load_transaction": _with("f_txn", f"""
        select trans_id, account_no, trans_type, cast(trans_amt as double) as trans_amt, dr_cr_flag,
               cast(trans_time as varchar) as trans_time, channel, {_nulls("teller_id opp_account memo")},
               'CORE' as source_system, {_STAMP} from f_txn"""),
    "ods_load_payment": _with("f_pay", f"""
        select pay_id, {_nulls("order_no payer_acct payee_acct pay_channel complete_time")},
               cast(amount as double) as amount, pay_status, cast(create_time as varchar) as create_time,
               'PAY' as source_system, {_STAMP} from f_pay"""),
    "ods_load_loan": _with("f_loan", f"""
        select contract_no, customer_id, {_nulls("loan_type rate_type repay_method guarantee_type loan_purpose")},
               cast(sign_date as varchar) as sign_date, cast(start_date as varchar) as start_date,
               cast(end_date as varchar) as end_date, cast(loan_amt as double) as loan_amt,
               cast(rate as double) as rate, term, status,
               'LOAN' as source_system, {_STAMP} from f_loan"""),
    "ods_load_card": _with("f_card", f"""
        select card_no, customer_id, {_nulls("card_type")}, card_level, cast(open_date as varchar) as open_date,
               cast(expire_date as varchar) as expire_date,
               cast(credit_limit as double) as credit_limit, 'ACTIVE' as status,
               'CC' as source_system, {_STAMP} from f_card"""),
    "ods_load_ebank": _with("f_ebank", f"""
        select trans_id, customer_id, trans_type, cast(amount as double) as amount,
               {_nulls("from_acct to_acct channel")}, cast(trans_time as varchar) as trans_time,
               'EBANK' as source_system, {_STAMP} from f_ebank"""),
    "ods_rejects": """
        select cast(event_id as varchar) as pay_id, event_type as pay_status,
               case event_type when 'error' then 'amount' else 'create_time' end as rejected
        from events where event_type in ('error', 'view')""",
    "day_overwrite": _with("f_account", f"""
        select case when status = 'NORMAL' then '{BEFORE}' else '{AFTER}' end as dt, status, count(*) as row_cnt
        from f_account group by 1, 2"""),
    "latest_day": "select cast(max(cast(l_shipdate as date)) as varchar) as dt from lineitem",
    "day_drop": _with("f_account", f"""
        select '{BEFORE}' as dt, status, count(*) as row_cnt from f_account where status = 'NORMAL' group by status"""),
    "json_export": _with("f_txn", """
        select channel, count(*) as cnt, cast(sum(trans_amt) as double) as amt from f_txn group by channel"""),
    "reconcile": _with(f"{_ALL_SOURCES} summary", " union all ".join(
        f"select '{name}' as table_name, count(*) as row_cnt from {block} t" for name, block in _COUNTED.items()
    )),
    "dq_checks": _with(f"{_ALL_SOURCES} f_event", " union all ".join([
        _key_rules("f_customer", "customer", "customer_id"), _key_rules("f_account", "account", "account_no"),
        _key_rules("f_balance", "balance", "account_no"), _key_rules("f_txn", "transaction", "trans_id"),
        _key_rules("f_pay", "payment", "pay_id"), _key_rules("f_loan", "loan", "contract_no"),
        _key_rules("f_card", "card", "card_no"), _key_rules("f_ebank", "ebank", "trans_id"),
        """select 'orphan_account', 'balance', count(*) filter (account_no not in (select account_no from f_account)),
                  count(*) from f_balance""",
        """select 'orphan_account', 'transaction', count(*) filter (account_no not in (select account_no from f_account)),
                  count(*) from f_txn""",
        """select 'orphan_customer', 'account', count(*) filter (customer_id not in (select customer_id from f_customer)),
                  count(*) from f_account""",
        """select 'balance_identity', 'balance', count(*) filter (balance <> avail_balance + frozen_amt), count(*)
           from f_balance""",
        "select 'row_count_drift', 'customer', 0, 1",
        """select 'row_count_drift', 'transaction',
                  case when abs((select count(*) from f_txn) - count(*)) > count(*) * 0.5 then 1 else 0 end, 1
           from f_event""",
    ])),
    "scd2_customer": _with("versions", f"""
        select customer_hash_key, cast(load_date as varchar) as load_date, cast(load_end_date as varchar) as load_end_date,
               is_current, cust_name, cust_level, status, hash_diff, 'CORE' as record_source,
               {_nulls("id_type id_no mobile phone email address cust_type gender birth_date nationality occupation")},
               cast(null as double) as annual_income, {_nulls("education open_date")}
        from versions"""),
    "customer_history": _with("versions", """
        select customer_hash_key, cast(load_date as varchar) as load_date, cast(load_end_date as varchar) as load_end_date,
               is_current, cust_level, status from versions"""),
    "version_checks": _with("versions", """
        , c as (select customer_hash_key, count(*) filter (is_current) as cur, count(*) as n,
                       count(*) filter (load_end_date < load_date) as back, count(distinct load_date) as starts
                from versions group by 1)
        select 'several_current' as rule, 'sat_customer' as table_name, count(*) filter (cur > 1) as failed,
               count(*) as total from c
        union all select 'ends_before_start', 'sat_customer', count(*) filter (back > 0), count(*) from c
        union all select 'repeated_start', 'sat_customer', count(*) filter (n <> starts), count(*) from c"""),
    "hub_first_seen": f"""
        select md5('CORE|' || customer_id || '|HUB_CUSTOMER') as customer_hash_key, customer_id,
               min(load_date) as load_date, 'CORE' as record_source
        from (select concat('CUST', lpad(cast(o_custkey as varchar), 8, '0')) as customer_id, '{BEFORE}' as load_date
              from orders join customer on o_custkey = c_custkey where {_live(BEFORE)}
              union all
              select concat('CUST', lpad(cast(o_custkey as varchar), 8, '0')), '{AFTER}'
              from orders join customer on o_custkey = c_custkey where {_live(AFTER)}) x
        group by customer_id""",
    "hub_new_rows": f"""
        select md5('CORE|' || customer_id || '|HUB_CUSTOMER') as customer_hash_key, customer_id,
               '{AFTER}' as load_date, 'CORE' as record_source
        from (select concat('CUST', lpad(cast(o_custkey as varchar), 8, '0')) as customer_id from orders where {_live(AFTER)}
              except
              select concat('CUST', lpad(cast(o_custkey as varchar), 8, '0')) from orders where {_live(BEFORE)}) x""",
    "link_end_dating": _with("before_link after_link", f"""
        select lk as cust_acct_hash_key, coalesce(b.ck, a.ck) as customer_hash_key, coalesce(b.ak, a.ak) as account_hash_key,
               'PRIMARY' as rel_type, cast(coalesce(b.open_date, a.open_date) as varchar) as rel_start_date,
               case when a.ck is null then '{AFTER}' end as rel_end_date, a.ck is not null as is_active,
               cast(coalesce(b.load_date, a.load_date) as varchar) as load_date, 'CORE' as record_source
        from before_link b full outer join after_link a using (lk)"""),
    "cdc_latest": _with("changes", """
        select trans_id, op, account_no, trans_type, cast(trans_amt as double) as trans_amt,
               cast(trans_time as varchar) as trans_time, channel from changes where n = 1 and op <> 'DELETE'"""),
    "cdc_apply": _with("changes", """
        select trans_id, cast(trans_amt as double) as trans_amt, channel from changes where n = 1 and op <> 'DELETE'
        union all
        select concat('ACCT', cast(c_custkey as varchar)), cast(cast(c_acctbal as decimal(18,2)) as double), c_mktsegment
        from customer where c_custkey not in (select user_id from events)"""),
    "fast_in_out": _fast("trans_time"),
    "stream_fast_in_out": _fast("date_trunc('second', trans_time)"),
    "night_activity": _with("f_event", f"""
        select account_no, cast(cast(trans_time as date) as varchar) as trans_date, count(*) as night_cnt,
               cast(sum(trans_amt) as double) as night_amt, 'NIGHT_ACTIVITY' as alert_type
        from f_event where {_NIGHT} group by 1, 2 having count(*) >= 2"""),
    "stream_decode": _with("f_event", """
        select trans_id, account_no, cast(trans_amt as double) as trans_amt,
               strftime(trans_time, '%Y-%m-%d %H:%M:%S') as trans_time, channel from f_event"""),
    "stream_large_amount": _with("f_event", f"""
        select trans_id, strftime(trans_time, '%Y-%m-%d %H:%M:%S') as trans_time, account_no,
               cast(trans_amt as double) as trans_amt, channel, 'LARGE_AMOUNT' as alert_type,
               case when trans_amt > {HIGH} then 'HIGH' else 'MEDIUM' end as risk_level
        from f_event where trans_amt > {LARGE}"""),
    "stream_channel_window": _with("f_event", _windows(3600) + """
               count(*) as txn_cnt, cast(sum(trans_amt) as double) as txn_amt, count(distinct account_no) as active_accounts
        from f_event group by 1, 2"""),
    "channel_window": _with("f_event", _windows(10) + """
               count(*) as txn_cnt, cast(sum(trans_amt) as double) as txn_amt, count(distinct account_no) as active_accounts
        from f_event group by 1, 2"""),
    "stream_channel_window_10s": _with("f_event", _windows(10) + """
               count(*) as txn_cnt, cast(sum(trans_amt) as double) as txn_amt, count(distinct account_no) as active_accounts
        from f_event group by 1, 2"""),
    "stream_channel_success": _with("f_event", _windows(300) + """
               count(*) as total_cnt, count(*) filter (trans_type <> 'error') as success_cnt
        from f_event group by 1, 2"""),
    "channel_success": _with("f_event", _windows(300) + """
               count(*) as total_cnt, count(*) filter (trans_type <> 'error') as success_cnt
        from f_event group by 1, 2"""),
    "day_versions": _with("f_account", f"""
        select cast(version as integer) as version, dt, status, count(*) as row_cnt
        from f_account, (values (1, 1, '{BEFORE}'), (2, 2, '{BEFORE}'), (3, 2, '{BEFORE}'), (3, 3, '{AFTER}'), (4, 3, '{AFTER}')) s(version, kind, dt)
        where kind = 1 or (kind = 2) = (status = 'NORMAL') group by 1, 2, 3"""),
    "lake_latest_day": """
        select cast(cast(l_shipdate as date) as varchar) as dt, count(*) as row_cnt from lineitem
        where cast(l_shipdate as date) = (select max(cast(l_shipdate as date)) from lineitem) group by 1""",
    "catalog_tables": _with("f_account", f"""
        select 'dwd_hub_account' as table_name, '{DAY}' as dt, count(distinct account_no) as row_cnt, count(distinct account_no) as keys from f_account
        union all select 'dwd_hub_org', '{DAY}', count(distinct branch_id), count(distinct branch_id) from f_account"""),
    "load_report": _with(f"{_ALL_SOURCES}", " union all ".join([
        *(f"""select '{rule}' as rule, '{name}' as table_name,
                     count(*) filter ({'coalesce(trim(' + key + "), '') = ''" if rule == 'null_key' else 'false'}) as failed, count(*) as total
              from {block} t"""
          for name, (block, key) in _LOADED.items() for rule in ("null_key", "rejected_cells")),
        """select 'balance_identity', 'balance', count(*) filter (balance <> avail_balance + frozen_amt), count(*) from f_balance""",
    ])),
    "hub_known_keys": f"""
        select md5('CORE|' || customer_id || '|HUB_CUSTOMER') as customer_hash_key, customer_id,
               min(load_date) as load_date, 'CORE' as record_source
        from (select concat('CUST', lpad(cast(o_custkey as varchar), 8, '0')) as customer_id, '{BEFORE}' as load_date
              from orders join customer on o_custkey = c_custkey where {_live(BEFORE)}
              union all
              select concat('CUST', lpad(cast(o_custkey as varchar), 8, '0')), '{AFTER}'
              from orders join customer on o_custkey = c_custkey where {_live(AFTER)}
              union all
              select concat('CUST', lpad(cast(c_custkey as varchar), 8, '0')), '{LAST}' from customer join nation on c_nationkey = n_nationkey) x
        where customer_id in (select concat('CUST', lpad(cast(c_custkey as varchar), 8, '0')) from customer join nation on c_nationkey = n_nationkey)
        group by customer_id""",
    "fast_in_out_split": _fast("trans_time"),
    "stream_fast_in_out_state": _fast("date_trunc('second', trans_time)"),
    "channel_sketches": _with("f_event", " union all ".join(
        f"""select '{text}' as width, cast(date_trunc('{unit}', trans_time) as varchar) as window_start, channel, count(*) as txn_cnt,
                   cast(sum(trans_amt) as double) as txn_amt, count(distinct account_no) as active_accounts, true as within_bound
            from f_event group by 2, 3""" for text, unit in (("1 hour", "hour"), ("1 day", "day"))
    )),
    "dashboard_cube": _with("f_event", f"""
        , h as (select cast(hour(trans_time) as varchar) as k, count(*) as cnt, sum(trans_amt) as amt from f_event group by 1),
        c as (select channel as k, count(*) as cnt, sum(trans_amt) as amt from f_event group by 1),
        t as (select count(*) as total_cnt, sum(trans_amt) as total_amt, cast(sum(trans_amt) / count(*) as decimal(18,2)) as avg_amt,
                     count(*) filter (trans_amt > {LARGE}) as large_txn_cnt, sum(case when trans_amt > {LARGE} then trans_amt else 0 end) as large_txn_amt,
                     count(*) filter ({_NIGHT}) as night_txn_cnt from f_event)
        select 'hourly_trend' as view, k as key, 'cnt' as measure, cast(cnt as double) as value from h
        union all select 'hourly_trend', k, 'amt', cast(amt as double) from h
        union all select 'channel_distribution', k, 'cnt', cast(cnt as double) from c
        union all select 'channel_distribution', k, 'amt', cast(amt as double) from c
        union all select 'transaction_summary', '', 'total_cnt', cast(total_cnt as double) from t
        union all select 'transaction_summary', '', 'total_amt', cast(total_amt as double) from t
        union all select 'transaction_summary', '', 'avg_amt', cast(avg_amt as double) from t
        union all select 'transaction_summary', '', 'success_cnt', cast(total_cnt as double) from t
        union all select 'risk_overview', '', 'total_txn', cast(total_cnt as double) from t
        union all select 'risk_overview', '', 'large_txn_cnt', cast(large_txn_cnt as double) from t
        union all select 'risk_overview', '', 'large_txn_amt', cast(large_txn_amt as double) from t
        union all select 'risk_overview', '', 'night_txn_cnt', cast(night_txn_cnt as double) from t
        union all select 'risk_overview', '', 'pass_rate', 99.85
        union all select 'risk_overview', '', 'abnormal_rate', 0.15"""),
    "kpi_change_asof": _with("d_kpi", """
        , w as (select * from d_kpi where isodow(cast(dt as date)) < 6),
        a as (select k.*, cast(cast(cast(k.dt as date) - interval 12 month as date) as varchar) as y_dt,
                     cast(cast(cast(k.dt as date) - interval 1 month as date) as varchar) as m_dt from w k),
        f as (select a.*,
                (select max(dt) from w where w.kpi_code = a.kpi_code and w.dt <= y_dt and cast(w.dt as date) >= cast(y_dt as date) - 10) as yoy_dt,
                (select max(dt) from w where w.kpi_code = a.kpi_code and w.dt <= m_dt and cast(w.dt as date) >= cast(m_dt as date) - 10) as mom_dt
              from a)
        select f.dt, f.kpi_code,
               case f.kpi_code when 'DAILY_TXN_CNT' then '当日交易笔数' else '当日交易金额' end as kpi_name,
               'PAYMENT' as kpi_category, f.kpi_value,
               case f.kpi_code when 'DAILY_TXN_CNT' then 'COUNT' else 'YUAN' end as kpi_unit,
               cast(cast((f.kpi_value - y.kpi_value) / nullif(y.kpi_value, 0) * 100 as decimal(18,2)) as double) as yoy_change,
               cast(cast((f.kpi_value - m.kpi_value) / nullif(m.kpi_value, 0) * 100 as decimal(18,2)) as double) as mom_change,
               yoy_dt, mom_dt
        from f left join w y on y.kpi_code = f.kpi_code and y.dt = f.yoy_dt left join w m on m.kpi_code = f.kpi_code and m.dt = f.mom_dt"""),
}

# a merge of the feed, in whatever order its parts come, is the feed applied at once
ORACLES["cdc_merge"] = ORACLES["cdc_apply"]
