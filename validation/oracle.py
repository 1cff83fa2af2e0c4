"""The same queries as DuckDB SQL, written independently of the Spark plans.

Only the dimension data are shared: they appear here as VALUES lists. The raw datasets are common table expressions.
"""

from __future__ import annotations

from collections.abc import Mapping

from tradewind.operators.dimensions import CITY_REGION, COUNTRY_CONTINENT, COUNTRY_REGION


def _values(mapping: Mapping[str, str]) -> str:
    def quote(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    return "(values " + ", ".join(f"({quote(k)}, {quote(v)})" for k, v in mapping.items()) + ")"


def _mdy(date: str) -> str:
    return f"concat(month({date}), '/', day({date}), '/', lpad(cast(year({date}) % 100 as varchar), 2, '0'))"


def _mmddyy(date: str) -> str:
    return f"strftime({date}, '%m/%d/%y')"


RAW = {
    "raw_sales": f"""
select o_orderkey as OrderID0, o_custkey as CustomerID, l_suppkey as EmployeeID,
  {_mdy("cast(o_orderdate as date)")} as OrderDate,
  {_mdy("(cast(o_orderdate as date) + 28)")} as RequiredDate,
  case when (l_orderkey + l_linenumber) % 11 = 0 then null else {_mdy("cast(l_shipdate as date)")} end as ShippedDate,
  o_orderkey % 3 + 1 as ShipVia, o_totalprice as Freight,
  concat('Ship ', o_custkey, '-', l_linenumber) as ShipName, concat('Street ', o_custkey) as ShipAddress,
  case o_orderkey % 6 when 0 then 'Reims' when 1 then 'Rio de Janeiro' when 2 then 'London' when 3 then 'Atlantis'
    when 4 then 'Seattle' end as ShipCity,
  case when o_orderkey % 5 = 0 then 'XX' end as ShipRegion,
  lpad(cast(o_custkey as varchar), 6, '0') as ShipPostalCode,
  case o_orderkey % 3 when 0 then 'France' when 1 then 'USA' else 'Brazil' end as ShipCountry,
  o_orderkey as OrderID14, l_partkey as ProductID,
  case when (l_orderkey + l_partkey) % 13 = 0 then null
    when (l_orderkey + l_partkey) % 17 = 0 then -cast(l_partkey % 20 + 1 as double)
    else cast(l_partkey % 20 + 1 as double) end as UnitPrice,
  case when (l_orderkey + l_linenumber) % 19 = 0 then null when (l_orderkey + l_linenumber) % 23 = 0 then -l_quantity
    else l_quantity end as Quantity,
  case when (l_orderkey + l_partkey) % 7 = 0 then null when (l_orderkey + l_partkey) % 5 = 0 then -l_discount
    else l_discount end as Discount
from lineitem join orders on l_orderkey = o_orderkey""",
    "raw_products": """
select p_partkey as ProductID, case when p_partkey % 10 = 0 then null else p_name end as ProductName,
  p_partkey % 10 as SupplierID, p_partkey % 11 as CategoryID,
  case p_partkey % 4 when 0 then concat(p_size, ' - 12 oz bottles') when 1 then concat(p_size, ' boxes x 20 bags')
    when 2 then concat(p_size, 'kg pkg.') end as QuantityPerUnit,
  case when p_partkey % 12 = 0 then '1k' when p_partkey % 16 = 1 then '1.5k'
    when p_partkey % 9 = 0 then concat('-', p_size, '.5') when p_partkey % 25 = 0 then 'n/a'
    else cast(p_size as varchar) end as UnitPrice,
  case when p_partkey % 15 = 0 then 'none' else concat(p_size, ' units') end as UnitsInStock,
  case when p_partkey % 14 = 0 then null else concat('-', p_size % 7) end as UnitsOnOrder
from part""",
    "raw_categories": """
select case when s_suppkey % 11 in (0, 10) then s_suppkey + 1000000 else s_suppkey end as CategoryID,
  case s_suppkey % 11 when 1 then 'Beverages' when 2 then 'Condiments#' when 3 then 'Confections' when 4 then ''
    when 5 then 'Grains/Cereals' when 6 then 'Meat/Poultry' when 7 then null when 8 then 'Seafood'
    else 'Tech' end as CategoryName,
  case s_suppkey % 11 when 1 then 'Soft drinks, coffees & teas' when 2 then null when 3 then ''
    when 4 then 'Cheeses and more' when 5 then 'Breads, crackers' when 6 then 'Prepared meats'
    when 7 then 'Produce, dried fruit' when 8 then 'Seaweed (and fish)' else 'Tools' end as Description,
  '0x' as Picture
from supplier""",
    "raw_customers": """
select c_custkey as CustomerID, case when c_custkey % 9 = 0 then null else c_name end as CompanyName,
  case when c_custkey % 8 = 0 then null else concat('City ', c_nationkey) end as City,
  case when c_custkey % 7 = 0 then null else lpad(cast(c_custkey as varchar), 6, '0') end as PostalCode,
  cast(null as varchar) as Region,
  case c_custkey % 10 when 0 then 'Germani#' when 1 then 'Poretugal#$' when 2 then 'UK' when 3 then 'France'
    when 4 then 'USA' when 5 then 'Brazil' when 6 then 'Japan' when 7 then null when 8 then 'Mexico'
    else 'Norway' end as Country,
  case when c_custkey % 6 = 0 then null else concat('(0', c_nationkey, ') 555-', c_custkey) end as Phone,
  case c_custkey % 5 when 0 then null when 1 then 'n.a.' else concat('+1.', c_custkey) end as Fax
from customer""",
    "raw_employees": f"""
select s_suppkey as EmployeeID, concat(s_name, case when s_suppkey % 3 = 0 then ' Müller' else '' end) as LastName,
  concat('Jo@n-', s_suppkey, ' O''Neil') as FirstName,
  case when s_suppkey % 4 = 0 then null else 'Rep' end as Title,
  case when s_suppkey % 3 = 0 then null else 'WA' end as Region,
  case when s_suppkey % 2 = 0 then 'UKA' else 'USA' end as Country, concat('(206) 555-', s_suppkey) as HomePhone,
  case when s_suppkey % 5 = 0 then '1/2/63'
    else {_mmddyy("date '1948-12-08' + cast(s_suppkey as int)")} end as BirthDate,
  {_mmddyy("date '1992-04-01' + cast(s_suppkey as int)")} as HireDate, '0x' as Photo,
  case when s_suppkey = 0 then null else cast(floor((s_suppkey - 1) / 3) as bigint) end as ReportsTo
from supplier""",
    "raw_suppliers": "select s_suppkey as SupplierID, s_name as CompanyName from supplier",
    "raw_tva": """
select c_custkey as CountryID,
  case c_custkey % 4 when 0 then 'Allemagne' when 1 then 'France' when 2 then 'Italy' end as Country,
  cast(c_custkey % 3 + 18 as double) as Rate
from customer""",
}


def _rebased(c: str) -> str:
    month, day, year = (f"split_part({c}, '/', {i})" for i in (1, 2, 3))
    month_day = f"concat(lpad({month}, 2, '0'), '-', lpad({day}, 2, '0'))"
    return f"""case when {c} is null then null
    when cast({year} as int) between 95 and 98 then concat(1926 + cast({year} as int), '-', {month_day})
    else {month_day} end as {c}"""


def _repaired(c: str) -> str:
    return f"coalesce(abs({c}), 0.0) as {c}"


def _price(c: str) -> str:
    return f"abs(try_cast(replace({c}, 'k', '000') as double))"


def _strict_date(c: str) -> str:
    year_month_day = f"concat('20', {c}[7:8], '-', {c}[1:2], '-', {c}[4:5])"
    return rf"""case when regexp_full_match({c}, '\d\d/\d\d/\d\d')
    then cast(try_cast({year_month_day} as date) as varchar) end"""


def _digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '', 'g')"


def _letters(c: str) -> str:
    return rf"regexp_replace({c}, '[^a-zA-Z\s''-]', '', 'g')"


def _alphanumeric(c: str, also: str = "") -> str:
    return rf"regexp_replace({c}, '[^a-zA-Z0-9\s{also}]', '', 'g')"


# Steps shared by several queries, each a common table expression on the ones before it.
STEPS = {
    "lines": "select OrderID0 as OrderID, * exclude (OrderID0, OrderID14) from raw_sales",
    "rebased": f"""
select * replace ({_rebased("OrderDate")}, {_rebased("RequiredDate")}, {_rebased("ShippedDate")}) from lines""",
    "filled": """
select * replace (coalesce(ShippedDate, cast(cast(try_cast(OrderDate as date) + 7 as date) as varchar)) as ShippedDate)
from rebased""",
    "repaired": f"""
select * replace ({_repaired("UnitPrice")}, {_repaired("Quantity")}, {_repaired("Discount")}) from lines""",
    "city_region": f"select * from {_values(CITY_REGION)} as t(city, region)",
    "country_region": f"select * from {_values(COUNTRY_REGION)} as t(country_name, region_name)",
    "country_continent": f"select * from {_values(COUNTRY_CONTINENT)} as t(country_name, continent)",
    "product_totals": """
select ProductID, cast(sum(cast(UnitPrice * Quantity as decimal(38,8))) as double) as total_revenue,
  cast(sum(cast(Quantity as decimal(38,8))) as double) as total_quantity_sold
from repaired group by ProductID""",
    "customer_totals": """
select CustomerID, cast(sum(cast(UnitPrice * Quantity * (1 - Discount) as decimal(38,8))) as double)
  as total_commande_client
from repaired group by CustomerID""",
    "demand": """
select ProductID, case when total_revenue > 10000 and total_quantity_sold > 500 then 'High Demand'
  when total_revenue between 2000 and 10000 or total_quantity_sold between 100 and 500 then 'Medium Demand'
  else 'Low Demand' end as StatutProduit
from raw_products left join product_totals using (ProductID)""",
    "value": """
select CustomerID, case when total_commande_client > 10000 then 'VIP'
  when total_commande_client between 5000 and 10000 then 'Moyen' else 'Low' end as StatutClient
from raw_customers left join customer_totals using (CustomerID)""",
    "plain_categories": f"""
select CategoryID, {_alphanumeric("CategoryName")} as CategoryName, {_alphanumeric("Description", ",")} as Description
from raw_categories""",
    "named_categories": r"""
select * replace (case when CategoryName is null or CategoryName = ''
  then regexp_split_to_array(Description, '[,\s]')[1] else CategoryName end as CategoryName) from plain_categories""",
    "categories": """
select * replace (case when Description is null or Description = '' then CategoryName else Description end
  as Description) from named_categories""",
    "classes": """
select ProductID, p.CategoryID, case when CategoryName like '%Beverages%' then 'Drinks'
  when regexp_matches(CategoryName, 'GrainsCereals|Condiments|Confections|Cheeses|MeatPoultry|Produce|Seafood')
  then 'Food' when CategoryName like '%Tech%' then 'Tech' else 'autres' end as ClassProduct
from raw_products p left join categories c on p.CategoryID = c.CategoryID""",
    "packages": r"""
select ProductID, try_cast(regexp_extract(QuantityPerUnit, '^(\d+)', 1) as int) as Quantity,
  replace(regexp_extract(QuantityPerUnit, '^\d+\s(.+)$', 1), '- ', '') as Description from raw_products""",
    "corrected": """
select * replace (case Country when 'Germani#' then 'Germany' when 'Poretugal#$' then 'Portugal'
  when 'UK' then 'United Kingdom' else Country end as Country) from raw_customers""",
    "phones": f"""
select * replace ({_digits("Phone")} as Phone, {_digits("Fax")} as Fax) from corrected""",
    "filled_customers": """
select * replace (coalesce(CompanyName, 'Unknown') as CompanyName, coalesce(City, 'Unknown') as City,
  coalesce(PostalCode, 'Unknown') as PostalCode, coalesce(Fax, 'Unknown') as Fax) from phones""",
    "placed": """
select * exclude (country_name, region_name) replace (coalesce(region_name, 'Unknown') as Region)
from filled_customers left join country_region on Country = country_name""",
    "on_continent": """
select * exclude (country_name, continent), coalesce(continent, 'Unknown') as CodeRegion
from placed left join country_continent on Country = country_name""",
    "employees": f"""
select EmployeeID, {_letters("LastName")} as LastName, {_letters("FirstName")} as FirstName,
  coalesce(Title, 'Unknown') as Title, coalesce(Region, 'Unknown') as Region,
  case when Country = 'UKA' then 'UK' else Country end as Country, {_digits("HomePhone")} as HomePhone,
  {_strict_date("BirthDate")} as BirthDate, {_strict_date("HireDate")} as HireDate, ReportsTo
from raw_employees""",
}
STEPS |= {
    "silver_sales": f"""
select * exclude (city, region) replace (coalesce(region, ShipRegion) as ShipRegion, {_repaired("UnitPrice")},
  {_repaired("Quantity")}, {_repaired("Discount")})
from filled left join city_region on ShipCity = city""",
    "silver_products": f"""
select ProductID, coalesce(ProductName, 'Unknown') as ProductName, SupplierID, r.CategoryID, QuantityPerUnit,
  {_price("UnitPrice")} as UnitPrice, try_cast({_digits("UnitsInStock")} as int) as UnitsInStock,
  try_cast({_digits("UnitsOnOrder")} as int) as UnitsOnOrder, Quantity, Description, StatutProduit, ClassProduct
from raw_products r join packages using (ProductID) join demand using (ProductID) join classes using (ProductID)""",
    "silver_customers": "select * from on_continent join value using (CustomerID)",
    "silver_vat": """
select CountryID, case Country when 'Allemagne' then 'Germany' else Country end as Country, Rate from raw_tva""",
}


def _query(body: str) -> str:
    """The body behind the common table expressions it needs, directly or through others."""
    tables = {**RAW, **STEPS}
    words = {name: set(_identifiers(sql)) for name, sql in tables.items()}
    needed: set[str] = set()
    pending = set(_identifiers(body)) & tables.keys()
    while pending:
        needed |= pending
        pending = set().union(*(words[name] for name in pending)) & tables.keys() - needed
    ctes = [f"{name} as ({sql})" for name, sql in tables.items() if name in needed]
    return f"with {', '.join(ctes)}\n{body}"


def _identifiers(sql: str) -> list[str]:
    return "".join(ch if ch.isalnum() or ch == "_" else " " for ch in sql).split()


# The columns of the datasets.
SALES_COLUMNS = (
    "OrderID", "CustomerID", "EmployeeID", "OrderDate", "RequiredDate", "ShippedDate", "ShipVia", "Freight",
    "ShipName", "ShipAddress", "ShipCity", "ShipRegion", "ShipPostalCode", "ShipCountry", "ProductID", "UnitPrice",
    "Quantity", "Discount",
)
RAW_SALES_COLUMNS = (
    "OrderID0", "CustomerID", "EmployeeID", "OrderDate", "RequiredDate", "ShippedDate", "ShipVia", "Freight",
    "ShipName", "ShipAddress", "ShipCity", "ShipRegion", "ShipPostalCode", "ShipCountry", "OrderID14", "ProductID",
    "UnitPrice", "Quantity", "Discount",
)
PRODUCT_COLUMNS = (
    "ProductID", "ProductName", "SupplierID", "CategoryID", "QuantityPerUnit", "UnitPrice", "UnitsInStock",
    "UnitsOnOrder", "Quantity", "Description", "StatutProduit", "ClassProduct",
)
CUSTOMER_COLUMNS = (
    "CustomerID", "CompanyName", "City", "PostalCode", "Region", "Country", "Phone", "Fax", "CodeRegion",
    "StatutClient",
)
EMPLOYEE_COLUMNS = (
    "EmployeeID", "LastName", "FirstName", "Title", "Region", "Country", "HomePhone", "BirthDate", "HireDate",
    "ReportsTo",
)
RAW_EMPLOYEE_COLUMNS = (
    "EmployeeID", "LastName", "FirstName", "Title", "Region", "Country", "HomePhone", "BirthDate", "HireDate",
    "Photo", "ReportsTo",
)


def _audit(*tables: tuple[str, str, tuple[str, ...]]) -> str:
    rows = "\nunion all ".join(
        f"""select '{label}' as table_name, '{c}' as column_name, count(*) filter ({c} is null) as null_count,
  count(*) as row_count, case when count(*) filter ({c} is null) > 0 then 'WARNING' else 'INFO' end as level
from {table}"""
        for table, label, columns in tables
        for c in columns
    )
    return _query(rows)


def _percentages(table: str, columns: tuple[str, ...]) -> str:
    shares = ", ".join(f"sum(case when {c} is null then 1 else 0 end) / count(*) * 100 as {c}" for c in columns)
    return _query(f"select {shares} from {table}")


_EMPLOYEE_DATES = "* replace (cast(BirthDate as date) as BirthDate, cast(HireDate as date) as HireDate)"

# dataset, table, rule, condition, action
_RULES = (
    ("sales", "raw_sales", "UnitPrice is missing", "UnitPrice is null", "set to 0"),
    ("sales", "raw_sales", "Quantity is missing", "Quantity is null", "set to 0"),
    ("sales", "raw_sales", "Discount is missing", "Discount is null", "set to 0"),
    ("sales", "raw_sales", "UnitPrice is negative", "UnitPrice < 0", "absolute value"),
    ("sales", "raw_sales", "Quantity is negative", "Quantity < 0", "absolute value"),
    ("sales", "raw_sales", "Discount is negative", "Discount < 0", "absolute value"),
    ("sales", "raw_sales", "Freight is negative", "Freight < 0", "kept"),
    *(("sales", "raw_sales", f"{c} is not finite", f"isinf({c}) or isnan({c})", "set to NULL")
      for c in ("Freight", "UnitPrice", "Quantity", "Discount")),
    *(rule for c in ("OrderDate", "RequiredDate", "ShippedDate") for rule in (
        ("sales", "raw_sales", f"{c} is not M/d/yy", rf"not regexp_full_match({c}, '\d{{1,2}}/\d{{1,2}}/\d\d')",
         "set to NULL"),
        ("sales", "raw_sales", f"{c} has a year outside 95-98",
         f"cast(split_part({c}, '/', 3) as int) not between 95 and 98", "year left out"))),
    ("sales", "raw_sales", "ShippedDate is missing", "ShippedDate is null", "order date plus 7 days"),
    ("sales", "raw_sales", "ShipCity is not mapped", "ShipCity not in (select city from city_region)",
     "ShipRegion left as it was"),
    ("products", "raw_products", "ProductName is missing", "ProductName is null", "set to Unknown"),
    ("products", "raw_products", "UnitPrice has a k suffix", "UnitPrice like '%k%'", "k becomes 000"),
    ("products", "raw_products", "UnitPrice is negative",
     "try_cast(replace(UnitPrice, 'k', '000') as double) < 0", "absolute value"),
    ("products", "raw_products", "UnitPrice is not a number",
     "UnitPrice is not null and try_cast(replace(UnitPrice, 'k', '000') as double) is null", "set to NULL"),
    ("products", "raw_products", "UnitsInStock has other than digits",
     "regexp_matches(UnitsInStock, '[^0-9]')", "digits kept"),
    ("categories", "raw_categories", "CategoryName is blank", "CategoryName is null or CategoryName = ''",
     "first word of Description"),
    ("categories", "raw_categories", "Description is blank", "Description is null or Description = ''",
     "CategoryName"),
    ("categories", "raw_categories", "CategoryName has symbols",
     r"regexp_matches(CategoryName, '[^a-zA-Z0-9\s]')", "symbols removed"),
    ("customers", "raw_customers", "CompanyName is missing", "CompanyName is null", "set to Unknown"),
    ("customers", "raw_customers", "City is missing", "City is null", "set to Unknown"),
    ("customers", "raw_customers", "PostalCode is missing", "PostalCode is null", "set to Unknown"),
    ("customers", "raw_customers", "Fax is missing", "Fax is null", "set to Unknown"),
    ("customers", "raw_customers", "Country is misspelt", "Country in ('Germani#', 'Poretugal#$', 'UK')",
     "corrected"),
    ("customers", "raw_customers", "Country has no region",
     "Country is null or Country not in (select country_name from country_region "
     "union all values ('Germani#'), ('Poretugal#$'), ('UK'))", "Region set to Unknown"),
    ("employees", "raw_employees", "LastName has other than letters",
     r"regexp_matches(LastName, '[^a-zA-Z\s''-]')", "other characters removed"),
    ("employees", "raw_employees", "FirstName has other than letters",
     r"regexp_matches(FirstName, '[^a-zA-Z\s''-]')", "other characters removed"),
    ("employees", "raw_employees", "Country is misspelt", "Country = 'UKA'", "corrected"),
    ("employees", "raw_employees", "BirthDate is not MM/dd/yy",
     f"BirthDate is not null and ({_strict_date('BirthDate')}) is null", "set to NULL"),
    ("employees", "raw_employees", "HireDate is not MM/dd/yy",
     f"HireDate is not null and ({_strict_date('HireDate')}) is null", "set to NULL"),
    ("employees", "raw_employees", "Title is missing", "Title is null", "set to Unknown"),
    ("employees", "raw_employees", "Region is missing", "Region is null", "set to Unknown"),
    ("vat", "raw_tva", "Country is misspelt", "Country = 'Allemagne'", "corrected"),
)


def _report() -> str:
    return _query(
        "\nunion all ".join(
            f"select '{dataset}' as dataset, '{rule}' as rule, count(*) as affected_rows, '{action}' as action "
            f"from {table} where {condition}"
            for dataset, table, rule, condition, action in _RULES
        )
    )


def _mismatch(condition: str) -> str:
    return _query(f"""
select s.OrderID, s.ProductID, s.UnitPrice as sales_UnitPrice, try_cast(p.UnitPrice as double) as products_UnitPrice
from lines s left join raw_products p on s.ProductID = p.ProductID
where s.UnitPrice {condition} try_cast(p.UnitPrice as double)""")


ORACLE = {
    "csv_roundtrip": _query("select * from raw_products"),
    "bronze_roundtrip": _query("select * from raw_sales"),
    "warehouse_run": _audit(
        ("silver_sales", "sales", SALES_COLUMNS),
        ("silver_products", "products", PRODUCT_COLUMNS),
        ("silver_customers", "customers", CUSTOMER_COLUMNS),
        ("categories", "categories", ("CategoryID", "CategoryName", "Description")),
        ("employees", "employees", EMPLOYEE_COLUMNS),
        ("raw_suppliers", "suppliers", ("SupplierID", "CompanyName")),
        ("silver_vat", "vat", ("CountryID", "Country", "Rate")),
    ),
    "graph_run": _query("""
select 'nodes_customer' as table_name, count(*) as n from raw_customers
union all select 'nodes_product', count(*) from raw_products
union all select 'nodes_supplier', count(*) from raw_suppliers
union all select 'nodes_employee', count(*) from raw_employees
union all select 'nodes_category', count(*) from raw_categories
union all select 'nodes_order', count(distinct OrderID) from lines
union all select 'edges_order_product', count(distinct (s.OrderID, s.ProductID))
  from lines s join raw_products p on s.ProductID = p.ProductID
union all select 'edges_sold', count(distinct (s.EmployeeID, s.OrderID))
  from lines s join raw_employees e on s.EmployeeID = e.EmployeeID
union all select 'edges_purchased', count(distinct (s.CustomerID, s.OrderID))
  from lines s join raw_customers c on s.CustomerID = c.CustomerID
union all select 'edges_supplies', count(distinct (p.SupplierID, p.ProductID))
  from raw_products p join raw_suppliers s on p.SupplierID = s.SupplierID
union all select 'edges_part_of', count(distinct (p.ProductID, p.CategoryID))
  from raw_products p join raw_categories c on p.CategoryID = c.CategoryID
union all select 'edges_reports_to', count(distinct (e.EmployeeID, e.ReportsTo))
  from raw_employees e join raw_employees m on e.ReportsTo = m.EmployeeID
union all select 'price_sync', count(*) from raw_sales"""),
    "sales_dedup_header": _query("select * from lines"),
    "sales_numeric_cast": _query("select OrderID, ProductID, Freight, UnitPrice, Quantity, Discount from lines"),
    "rebase_years": _query("select OrderID, ProductID, OrderDate, RequiredDate, ShippedDate from rebased"),
    "shipped_date_fill": _query("select OrderID, ProductID, OrderDate, ShippedDate from filled"),
    "sales_repair_numbers": _query("select OrderID, ProductID, UnitPrice, Quantity, Discount from repaired"),
    "ship_region": _query("""
select OrderID, ProductID, ShipCity, coalesce(region, ShipRegion) as ShipRegion
from lines left join city_region on ShipCity = city"""),
    "unmapped_region_count": _query("""
select count(*) as n from lines left join city_region on ShipCity = city
where coalesce(region, ShipRegion) is null"""),
    "missing_cities": _query("""
select distinct ShipCity from raw_sales where ShipCity not in (select city from city_region)"""),
    "silver_sales": _query("select * from silver_sales"),
    "line_revenue": _query("select OrderID, ProductID, UnitPrice * Quantity as total_sales_per_product from repaired"),
    "line_net_total": _query("""
select OrderID, ProductID, UnitPrice * Quantity * (1 - Discount) as total_commande from repaired"""),
    "product_sales_totals": _query("select * from product_totals"),
    "customer_totals": _query("select * from customer_totals"),
    "category_clean": _query("select * from plain_categories"),
    "category_crossfill": _query("select * from categories"),
    "silver_categories": _query("select * from categories"),
    "product_stock_clean": _query(f"""
select ProductID, try_cast({_digits("UnitsInStock")} as int) as UnitsInStock,
  try_cast({_digits("UnitsOnOrder")} as int) as UnitsOnOrder from raw_products"""),
    "product_price_clean": _query(f"select ProductID, {_price('UnitPrice')} as UnitPrice from raw_products"),
    "quantity_per_unit": _query("select * from packages"),
    "product_demand_tier": _query("select * from demand"),
    "product_class": _query("select * from classes"),
    "product_origin": _query("""
select ProductID, case when CategoryName in ('Cheeses', 'MeatPoultry', 'Seafood') then 'Animal'
  when CategoryName in ('Beverages', 'Condiments', 'Confections', 'GrainsCereals', 'Produce') then 'Plant'
  else 'Unknown' end as OriginProduct
from raw_products p left join categories c on p.CategoryID = c.CategoryID"""),
    "silver_products": _query("select * from silver_products"),
    "phone_digits": _query("select CustomerID, Phone, Fax from phones"),
    "fill_unknown": _query("select CustomerID, CompanyName, City, PostalCode, Fax from filled_customers"),
    "country_corrections": _query("select CustomerID, Country from corrected"),
    "customer_region": _query("select CustomerID, Country, Region from placed"),
    "customer_continent": _query("select CustomerID, Country, CodeRegion from on_continent"),
    "unknown_region_count": _query("select count(*) as n from placed where Region = 'Unknown'"),
    "customer_value_tier": _query("select * from value"),
    "silver_customers": _query("select * from silver_customers"),
    "employee_name_clean": _query("select EmployeeID, LastName, FirstName, HomePhone from employees"),
    "employee_country": _query("select EmployeeID, Country from employees"),
    "employee_dates": _query("select EmployeeID, BirthDate, HireDate from employees"),
    "drop_blob_columns": _query("select * exclude (Photo) from raw_employees"),
    "silver_employees": _query(f"select {_EMPLOYEE_DATES} from employees"),
    "vat_country": _query("select CountryID, Country from silver_vat"),
    "silver_vat": _query("select * from silver_vat"),
    "null_audit_employees": _audit(("raw_employees", "employees", RAW_EMPLOYEE_COLUMNS)),
    "null_audit_employees_cleaned": _audit(("employees", "employees_cleaned", EMPLOYEE_COLUMNS)),
    "null_audit_sales": _audit(("raw_sales", "sales", RAW_SALES_COLUMNS)),
    "null_percentages": _percentages("rebased", SALES_COLUMNS),
    "duplicate_keys": _query("""
select OrderID, ProductID, count(*) as n from lines group by OrderID, ProductID having count(*) > 1"""),
    "table_row_counts": _query(
        "\nunion all ".join(f"select '{name}' as table_name, count(*) as n from {name}" for name in RAW)
    ),
    "quality_report": _report(),
    "price_sync": _query("""
select OrderID0, CustomerID, EmployeeID, OrderDate, RequiredDate, ShippedDate, ShipVia, Freight, ShipName, ShipAddress,
  ShipCity, ShipRegion, ShipPostalCode, ShipCountry, s.ProductID as sales_ProductID,
  try_cast(p.UnitPrice as double) as sales_UnitPrice, Quantity, Discount
from raw_sales s left join raw_products p on s.ProductID = p.ProductID"""),
    "price_mismatch": _mismatch("<>"),
    "price_mismatch_null_safe": _mismatch("is distinct from"),
    "graph_nodes_customer": _query("""
select CompanyName as companyName, CustomerID as customerID, Fax as fax, Phone as phone from raw_customers"""),
    "graph_nodes_product": _query("""
select ProductName as productName, ProductID as productID, try_cast(UnitPrice as double) as unitPrice
from raw_products"""),
    "graph_nodes_supplier": _query("""
select CompanyName as companyName, SupplierID as supplierID from raw_suppliers"""),
    "graph_nodes_employee": _query("""
select EmployeeID as employeeID, FirstName as firstName, LastName as lastName, Title as title from raw_employees"""),
    "graph_nodes_category": _query("""
select CategoryID as categoryID, CategoryName as categoryName, Description as description from raw_categories"""),
    "graph_nodes_order": _query("""
select OrderID as orderID, min(ShipName) as shipName from lines group by OrderID"""),
    "graph_edges_order_product": _query("""
select OrderID as src, ProductID as dst, UnitPrice as unitPrice, Quantity as quantity
from lines where ProductID in (select ProductID from raw_products)
qualify row_number() over (partition by OrderID, ProductID
  order by UnitPrice nulls last, Quantity nulls last) = 1"""),
    "graph_edges_sold": _query("""
select distinct e.EmployeeID as src, OrderID as dst from lines s join raw_employees e on s.EmployeeID = e.EmployeeID"""),
    "graph_edges_purchased": _query("""
select distinct c.CustomerID as src, OrderID as dst from lines s join raw_customers c on s.CustomerID = c.CustomerID"""),
    "graph_edges_supplies": _query("""
select distinct s.SupplierID as src, ProductID as dst
from raw_products p join raw_suppliers s on p.SupplierID = s.SupplierID"""),
    "graph_edges_part_of": _query("""
select distinct ProductID as src, c.CategoryID as dst
from raw_products p join raw_categories c on p.CategoryID = c.CategoryID"""),
    "graph_edges_reports_to": _query("""
select distinct e.EmployeeID as src, m.EmployeeID as dst
from raw_employees e join raw_employees m on e.ReportsTo = m.EmployeeID"""),
}

_PRODUCT_TEXTS = ", ".join(f"cast({c} as varchar) as {c}" for c in ("ProductID", "SupplierID", "CategoryID"))
_PRODUCT_GUESSES = ", ".join(
    f"cast({c} as integer) as {c}" for c in ("ProductID", "SupplierID", "CategoryID", "UnitsOnOrder")
)


def _lake_audits() -> str:
    bronze = {
        "sales": RAW_SALES_COLUMNS,
        "products": (*PRODUCT_COLUMNS[:5], "UnitPrice", "UnitsInStock", "UnitsOnOrder"),
        "customers": tuple(c for c in CUSTOMER_COLUMNS if c not in ("CodeRegion", "StatutClient")),
        "employees": RAW_EMPLOYEE_COLUMNS,
        "categories": ("CategoryID", "CategoryName", "Description", "Picture"),
        "suppliers": ("SupplierID", "CompanyName"),
        "tva": ("CountryID", "Country", "Rate"),
    }
    silver = {
        "sales": ("silver_sales", SALES_COLUMNS),
        "products": ("silver_products", PRODUCT_COLUMNS),
        "customers": ("silver_customers", CUSTOMER_COLUMNS),
        "categories": ("categories", ("CategoryID", "CategoryName", "Description")),
        "employees": ("employees", EMPLOYEE_COLUMNS),
        "suppliers": ("raw_suppliers", ("SupplierID", "CompanyName")),
        "vat": ("silver_vat", ("CountryID", "Country", "Rate")),
    }
    tables = {f"bronze.{name}": (f"raw_{name}", columns) for name, columns in bronze.items()}
    tables |= {f"silver.{name}": found for name, found in silver.items()}
    rows = [
        f"select 'null_audit' as audit, '{label}' as table_name, '{c}' as item, count(*) filter ({c} is null) as n,"
        f" count(*) as row_count, case when count(*) filter ({c} is null) > 0 then 'WARNING' else 'INFO' end as note from {t}"
        for label, (t, columns) in tables.items()
        for c in columns
    ]
    rows += [f"select 'row_counts', '{label}', 'rows', count(*), null, null from {t}" for label, (t, _) in tables.items()]
    keys = {
        "categories": ("raw_categories", "CategoryID"),
        "products": ("raw_products", "ProductID"),
        "customers": ("raw_customers", "CustomerID"),
        "employees": ("raw_employees", "EmployeeID"),
        "orders": ("(select distinct OrderID, EmployeeID, CustomerID, ShipName from lines)", "OrderID"),
    }
    rows += [
        f"select 'duplicate_keys', '{name}', concat_ws(', ', {key}), count(*), null, null from {t} group by {key} having count(*) > 1"
        for name, (t, key) in keys.items()
    ]
    rows += [
        f"select 'quality_report', '{dataset}', '{rule}', count(*), null, '{action}' from {table} where {condition}"
        for dataset, table, rule, condition, action in _RULES
    ]
    return _query("\nunion all ".join(rows))


ORACLE |= {
    "csv_strings": _query(f"select * replace ({_PRODUCT_TEXTS}) from raw_products"),
    "csv_inferred": _query(f"select * replace ({_PRODUCT_GUESSES}) from raw_products"),
    "landing_audit": _query(
        "select 'products' as table_name, count(*) as n_rows, count(*) filter (ProductID % 7 in (3, 5)) as n_malformed"
        " from raw_products"
    ),
    "malformed_lines": _query(
        "select concat_ws(',', ProductID, coalesce(ProductName, ''), SupplierID) as line from raw_products"
        " where ProductID % 7 = 3 union all"
        " select concat_ws(',', ProductID, coalesce(ProductName, ''), SupplierID, CategoryID, coalesce(QuantityPerUnit, ''),"
        " coalesce(UnitPrice, ''), coalesce(UnitsInStock, ''), coalesce(UnitsOnOrder, ''), 'surplus')"
        " from raw_products where ProductID % 7 = 5"
    ),
    "landed_sales": _query("select * replace (cast(CustomerID as varchar) as CustomerID) from raw_sales"),
    **{f"lake_silver_{t}": ORACLE[f"silver_{t}"] for t in ("sales", "categories", "products", "customers", "employees", "vat")},
    "lake_silver_suppliers": _query("select * from raw_suppliers"),
    **{
        f"lake_graph_{name.removeprefix('graph_')}": sql
        for name, sql in ORACLE.items()
        if name.startswith(("graph_nodes_", "graph_edges_"))
    },
    "lake_price_sync": ORACLE["price_sync"],
    "lake_audits": _lake_audits(),
    "duplicate_categories": _query("""
select CategoryID, cast(2 as bigint) as n from raw_categories where CategoryID % 5 = 0"""),
    "duplicate_orders": _query("""
select OrderID, count(*) as n from (select distinct OrderID, EmployeeID, CustomerID, ShipName from lines)
group by OrderID having count(*) > 1"""),
}
