"""Small tables with results worked out by hand."""

from __future__ import annotations

from types import SimpleNamespace

from tablewright.sources.ingest import literal_rows
from tablewright.sources.spec import Check, ForeignKey, table
from tablewright.workloads.fixed import ORDER_STATUSES

# --- fixed values: the company with employees, departments and projects ---------------

COMPANY_EMP = table(
    "employees",
    "emp_id bigint, emp_name varchar(50), dept_id int, salary decimal(10,2), manager_id bigint,"
    "segment text, email text, hire_date date",
    primary_key=("emp_id",),
)
COMPANY_DEPT = table(
    "departments", "dept_id int, dept_name varchar(50), location varchar(50)", primary_key=("dept_id",)
)
COMPANY_PROJ = table(
    "projects",
    "project_id bigint, project_name varchar(50), dept_id int, budget decimal(10,2)",
    primary_key=("project_id",),
)
# John, Jane, Sarah and Tom report to Mike
EMPLOYEES = [
    (1, "John Smith", 101, 50000, 3),
    (2, "Jane Doe", 102, 60000, 3),
    (3, "Mike Johnson", 101, 55000, None),
    (4, "Sarah Williams", 103, 65000, 3),
    (5, "Tom Brown", None, 45000, 3),
]
# the workloads filter on ASIA, so that is where building A stands
DEPARTMENTS = [
    (101, "IT", "ASIA"),
    (102, "HR", "Building B"),
    (103, "Finance", "Building C"),
    (104, "Marketing", "Building D"),
]
PROJECTS = [
    (1, "Website Redesign", 101, 100000),
    (2, "Employee Training", 102, 50000),
    (3, "Budget Analysis", 103, 75000),
    (4, "Cloud Migration", 101, 150000),
    (5, "AI Research", None, 200000),
]

# --- fixed values: the firm with assignments ------------------------------------------

FIRM_EMP = table(
    "employees",
    "emp_id bigint, first_name text, last_name text, segment text, salary decimal(10,2),"
    "hire_date date, manager_id bigint, email text",
)
FIRM_PROJ = table(
    "projects", "project_id bigint, project_name text, budget decimal(12,2), end_date date, status text"
)
FIRM_ASG = table(
    "assignments",
    "assignment_id bigint, emp_id bigint, project_id bigint, hours_worked decimal(5,1), assignment_date date",
)
# BUILDING, FURNITURE and HOUSEHOLD stand for the IT, Sales and HR departments
FIRM_EMPLOYEES = [
    (1, "Jorn", "Stell", "BUILDING", 75000, "2020-01-15", None, "jorn.stell@firm.test"),
    (2, "Sanna", "Jorvik", "BUILDING", 65000, "2020-03-20", 1, "sanna.j@firm.test"),
    (3, "Milo", "Brome", "FURNITURE", 55000, "2019-06-10", None, "mbrome@firm.test"),
    (4, "Emra", "Darrow", "HOUSEHOLD", 60000, "2021-02-01", None, "emra.darrow@firm.test"),
    (5, "Rorik", "Wend", "BUILDING", 70000, "2020-08-15", 1, None),
    (6, "Lira", "Ambrel", "FURNITURE", 58000, "2021-05-20", 3, "lira.a@firm.test"),
]
FIRM_PROJECTS = [
    (1, "Harbour Survey", 150000, "2024-06-30", "Active"),
    (2, "Ledger Rollout", 200000, "2024-12-31", "Active"),
    (3, "Orchard Drive", 80000, "2024-05-31", "Completed"),
    (4, "Archive Transfer", 120000, None, "Active"),
]
FIRM_ASSIGNMENTS = [
    (1, 1, 1, "120.5", "2024-01-15"),
    (2, 2, 1, "95.0", "2024-01-20"),
    (3, 1, 4, "80.0", "2024-02-01"),
    (4, 3, 3, "60.0", "2024-03-05"),
    (5, 5, 2, "110.0", "2024-02-20"),
    (6, 6, 3, "75.5", "2024-03-10"),
]

# --- fixed values: the shop -----------------------------------------------------------

SHOP = {
    "customers": table(
        "customers",
        "customer_id integer, name text!, email text!, phone text, registration_date date!",
        primary_key=("customer_id",),
        unique=(("email",),),
    ),
    "products": table(
        "products",
        "product_id integer, name text!, description text, price numeric!, stock_quantity integer!",
        primary_key=("product_id",),
        checks=(Check("price", "price >= 0"), Check("stock_quantity", "stock_quantity >= 0")),
    ),
    "orders": table(
        "orders",
        "order_id integer, customer_id integer, order_date date!, total_amount numeric, status text!",
        primary_key=("order_id",),
        checks=(
            Check("total_amount", "total_amount >= 0"),
            Check("status", f"status IN {ORDER_STATUSES}"),
        ),
        foreign_keys=(ForeignKey(("customer_id",), "customers", ("customer_id",), "set null"),),
    ),
    "details": table(
        "details",
        "order_detail_id integer, order_id integer, product_id integer, quantity integer!, unit_price numeric!",
        primary_key=("order_detail_id",),
        checks=(Check("quantity", "quantity > 0"), Check("unit_price", "unit_price >= 0")),
        foreign_keys=(
            ForeignKey(("order_id",), "orders", ("order_id",), "cascade"),
            ForeignKey(("product_id",), "products", ("product_id",), "restrict"),
        ),
    ),
}
SHOP_ROWS = {
    "customers": [
        (1, "Alice Johnson", "alice.j@example.com", "123-456-7890", "2023-01-15"),
        (2, "Bob Brown", "bob.brown@example.com", "123-456-7891", "2023-02-01"),
        (3, "Carol Davis", "carol.d@example.com", None, "2023-02-20"),
        (4, "David Wilson", "david.w@example.com", "123-456-7893", "2023-03-10"),
        (5, "Eva Miller", "eva.m@example.com", "123-456-7894", "2023-04-05"),
    ],
    "products": [
        (1, "Wireless Mouse", "Ergonomic wireless mouse", "29.99", 100),
        (2, "Mechanical Keyboard", "RGB mechanical keyboard", "89.99", 50),
        (3, 'Monitor 24"', "Full HD 24-inch monitor", "199.99", 30),
        (4, "Laptop Stand", "Aluminum laptop stand", "49.99", 75),
        (5, "Webcam", "1080p HD webcam", "69.99", 40),
    ],
    "orders": [
        (101, 1, "2023-09-25", "119.98", "delivered"),
        (102, 2, "2023-09-26", "89.99", "processing"),
        (103, 3, "2023-09-26", "269.98", "pending"),
        (104, 1, "2023-09-27", "49.99", "shipped"),
        (105, 4, "2023-09-28", "199.99", "delivered"),
    ],
    "details": [
        (1, 101, 1, 2, "29.99"),
        (2, 101, 4, 1, "49.99"),
        (3, 102, 2, 1, "89.99"),
        (4, 103, 3, 1, "199.99"),
        (5, 103, 5, 1, "69.99"),
        (6, 104, 4, 1, "49.99"),
        (7, 105, 3, 1, "199.99"),
    ],
}


def company(spark):
    """A stand-in for ``Tables`` that holds the company."""
    five = ["emp_id", "emp_name", "dept_id", "salary", "manager_id"]
    return SimpleNamespace(
        spark=spark,
        emp=literal_rows(spark, COMPANY_EMP, EMPLOYEES, five),
        dept=literal_rows(spark, COMPANY_DEPT, DEPARTMENTS),
        proj=literal_rows(spark, COMPANY_PROJ, PROJECTS),
    )


def firm(spark):
    """A stand-in for ``Tables`` that holds the firm."""
    emp = literal_rows(spark, FIRM_EMP, FIRM_EMPLOYEES)
    return SimpleNamespace(
        spark=spark,
        emp=emp.selectExpr("*", "first_name || ' ' || last_name AS emp_name"),
        proj=literal_rows(spark, FIRM_PROJ, FIRM_PROJECTS),
        asg=literal_rows(spark, FIRM_ASG, FIRM_ASSIGNMENTS),
    )


def shop(spark):
    return {name: literal_rows(spark, SHOP[name], rows) for name, rows in SHOP_ROWS.items()}


def rows(df, *columns):
    """Sorted rows; decimals as floats for short expectations."""
    from decimal import Decimal

    got = (df.select(*columns) if columns else df).collect()
    plain = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in got]
    return sorted(plain, key=lambda r: [(v is None, v) for v in r])
