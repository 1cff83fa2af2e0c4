"""The datasets of the warehouse: file names, column types at landing, and columns of the silver layer."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Dataset:
    """A raw CSV file and the types its columns land with. Columns not named in ``types`` land as strings.
    The sales file has its order id once or twice; the type holds for both copies.

    Dates and dirty numbers (``'1k'``, ``'39 units'``) land as strings, so that the cleaning sees them unchanged.
    """

    name: str
    csv_file: str
    types: dict[str, str] = field(default_factory=dict)


DATASETS = {
    d.name: d
    for d in (
        Dataset(
            "sales",
            "sales.csv",
            {
                "OrderID": "bigint",
                "EmployeeID": "bigint",
                "ShipVia": "bigint",
                "Freight": "double",
                "ProductID": "bigint",
                "UnitPrice": "double",
                "Quantity": "double",
                "Discount": "double",
            },
        ),
        Dataset("products", "products.csv", {"ProductID": "bigint", "SupplierID": "bigint", "CategoryID": "bigint"}),
        Dataset("customers", "customers.csv"),
        Dataset("employees", "employees.csv", {"EmployeeID": "bigint", "ReportsTo": "bigint"}),
        Dataset("categories", "categories.csv", {"CategoryID": "bigint"}),
        Dataset("suppliers", "suppliers.csv", {"SupplierID": "bigint"}),
        Dataset("tva", "tva_country.csv"),
    )
}

# Type of each silver column whose type the cleaning fixes. Other columns keep the type they landed with.
SILVER_TYPES = {
    "sales": {
        "OrderDate": "string",
        "RequiredDate": "string",
        "ShippedDate": "string",
        "Freight": "double",
        "ShipRegion": "string",
        "UnitPrice": "double",
        "Quantity": "double",
        "Discount": "double",
    },
    "products": {
        "ProductName": "string",
        "UnitPrice": "double",
        "UnitsInStock": "int",
        "UnitsOnOrder": "int",
        "Quantity": "int",
        "Description": "string",
        "StatutProduit": "string",
        "ClassProduct": "string",
    },
    "customers": {"Region": "string", "CodeRegion": "string", "StatutClient": "string"},
    "categories": {"CategoryName": "string", "Description": "string"},
    "employees": {"BirthDate": "date", "HireDate": "date"},
    "suppliers": {},
    "vat": {"Country": "string"},
}
