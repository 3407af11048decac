"""Schemas of the six source files and the names their columns get in staging."""

from __future__ import annotations

from pyspark.sql import types as T

from starmart.functions.numbers import DISCOUNT, PRICE

# Column names and types of the files. Ids are long, so that they outlast int.
CATEGORIES = {"CategoryID": "long", "CategoryName": "string", "Description": "string"}
CUSTOMERS = {
    "CustomerID": "string",
    "CompanyName": "string",
    "ContactName": "string",
    "ContactTitle": "string",
    "Address": "string",
    "City": "string",
    "Region": "string",
    "PostalCode": "string",
    "Country": "string",
    "Phone": "string",
    "Fax": "string",
}
PRODUCTS = {
    "ProductID": "long",
    "ProductName": "string",
    "SupplierID": "long",
    "CategoryID": "long",
    "QuantityPerUnit": "string",
    "UnitPrice": PRICE,
    "UnitsInStock": "int",
    "UnitsOnOrder": "int",
    "ReorderLevel": "int",
    "Discontinued": "int",
}
ORDERS = {
    "OrderID": "long",
    "CustomerID": "string",
    "EmployeeID": "long",
    "OrderDate": "string",
    "RequiredDate": "string",
    "ShippedDate": "string",
    "ShipVia": "int",
    "Freight": PRICE,
    "ShipName": "string",
    "ShipAddress": "string",
    "ShipCity": "string",
    "ShipRegion": "string",
    "ShipPostalCode": "string",
    "ShipCountry": "string",
}
ORDER_DETAILS = {
    "OrderID": "long",
    "ProductID": "long",
    "UnitPrice": PRICE,
    "Quantity": "int",
    "Discount": DISCOUNT,
}
EMPLOYEES = {
    "EmployeeID": "long",
    "LastName": "string",
    "FirstName": "string",
    "Title": "string",
    "TitleOfCourtesy": "string",
    "BirthDate": "string",
    "HireDate": "string",
    "Address": "string",
    "City": "string",
    "Region": "string",
    "PostalCode": "string",
    "Country": "string",
    "HomePhone": "string",
    "Extension": "string",
    "Photo": "string",
    "Notes": "string",
    "ReportsTo": "string",
    "PhotoPath": "string",
}

FILES = {
    "Categories": CATEGORIES,
    "Customers": CUSTOMERS,
    "Products": PRODUCTS,
    "Orders": ORDERS,
    "OrderDetails": ORDER_DETAILS,
    "Employees": EMPLOYEES,
}


TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    PRICE: T.DecimalType(10, 2),
    DISCOUNT: T.DecimalType(5, 4),
}


def struct_of(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns.items()])


def snake_case(name: str) -> str:
    """``CategoryID`` -> ``category_id``, ``ShipVia`` -> ``ship_via``."""
    words = ""
    for before, char in zip(" " + name, name):
        if char.isupper() and before.islower():
            words += "_"
        words += char.lower()
    return words
