"""Small raw files in the layout of the source folders; each row hits a rule."""

from __future__ import annotations

import json
from pathlib import Path

CUSTOMERS = {
    "Insurance 1/customers_1.csv": """CustomerID,Reg,State,City,Education,Marital_status,Default,HHInsurance,CarLoan,Balance
101,W,Ohio,Dayton,terto,Married,0,1,0,2000
102,Q,Ohio,Dayton,primary,single,0,1,0,10
,West,Ohio,Dayton,primary,single,0,1,0,10
,West,Ohio,Dayton,primary,single,0,1,0,11
103,c, ,Dayton,primary,single,7,,1,-500.25
""",
    "Insurance 2/customers_2.csv": """Customer_ID,Region,State,City_in_state,Edu,Marital,Job,Default,HHInsurance,CarLoan,Balance
201,Central,Texas,Austin,NA,NA,admin.,0,0,1,abc
101,East,Texas,Austin,secondary,unknown,Management,0,0,1,5
""",
    "Insurance 3/customers_3.csv": """cust_id,Region,State,City,Education,Marital_status,Job,Default,HHInsurance,CarLoan,Balance,Extra
301,n,Utah,Provo,tertiary,widow,NA,1,1,1,7,surplus
x1,North,Utah,Provo,tertiary,widow,NA,1,1,1,7,
""",
    "Insurance_6/customers_6.csv": """CustomerID,Region,State,City,Education,Marital_status,Job,Default,HHInsurance,CarLoan,Balance
601,South,Iowa,Ames,divorced,secondary,Services.,0,0,0,1
""",
}
CARS = {"Insurance 4/cars.csv": """car_id,name,km_driven,fuel,transmission,mileage,engine,max_power,torque,seats,model
1,Alto LX,45000,Petrol,Manual,23.4 kmpl,1248 CC,74 bhp,"190Nm@ 2,000rpm",5,Maruti
2,Far,600000,Diesel,Automatic,20 kmpl,"1,248 CC",74 bhp,n/a,5,Maruti
3,Neg,-5,Petrol,Manual,20 kmpl,1248 CC,74 bhp,190Nm,5,Maruti
4,Zero,10,Petrol,Manual,0 kmpl,1248 CC,74 bhp,190Nm,5,Maruti
5,Steam,10,steam,Manual,20 kmpl,1248 CC,74 bhp,190Nm,5,Maruti
6,Cvt,10,Petrol,cvt,20 kmpl,1248 CC,74 bhp,190Nm,5,Maruti
7,Two,10,Petrol,Manual,20 kmpl,1248 CC,74 bhp,190Nm,2,Maruti
8," ",10,Petrol,Manual,20 kmpl,1248 CC,74 bhp,190Nm,5,Maruti
,NoId,10,Petrol,Manual,20 kmpl,1248 CC,74 bhp,190Nm,5,Maruti
10,Gap,,Petrol,Manual,20 kmpl,1248 CC,74 bhp,190Nm,5,Maruti
,,,,,,,,,,
"""}
POLICY = {"Insurance 5/policy.csv": """policy_number,policy_bind_date,policy_state,policy_csl,policy_deductable,policy_annual_premium,umbrella_limit,car_id,customer_id
5001,2016-04-01,il,100/300,500,1200.50,0,1,101
5002,2016-04-01,oh,250/500,500,1200.50,-1000000,1,301
5003,01/04/2016,oh,250/500,500,1200.50,0,1,101
5004,2016-04-01,oh,100,500,1200.50,0,1,101
5005,2016-04-01,oh,250/500,500,0,0,1,101
5006,2016-04-01,oh,250/500,-1,10,0,1,101
5007,2016-04-01,oh,250/500,0,10,0,1,
5008,2016-04-01,oh,250/500,0,10,6000000,1,999
"""}
SALES = {
    "Insurance 2/sales_1.csv": """sales_id,ad_placed_on,sold_on,original_selling_price,Region,State,City,seller_type,owner,car_id
9001,10-02-2017 20:22,20-03-2017 09:00,350000,East,Ohio,Dayton,Trustmark Dealer,First Owner,1
9002,10-02-2017 20:22,,1000,west,Ohio,,broker,Second Owner,1
9003,2017-02-10,,1000,west,Ohio,Dayton,Dealer,First Owner,1
9004,10-02-2017 20:22,,0,west,Ohio,Dayton,Dealer,First Owner,1
,,,,,,,,,
""",
    "Sales_2.csv": """sales_id,ad_placed_on,sold_on,original_selling_price,Region,State,City,seller_type,owner,car_id
9005,10-02-2017 20:22,,1000,nowhere,Ohio,Dayton,Dealer,First Owner,1
9006,10-02-2017 20:22,,1000,north,Ohio,Dayton,Dealer,First Owner,
9007,10-02-2017 20:22,,500,north,Ohio,Dayton,Dealer,First Owner,77
"""}


def claim(**changes) -> dict:
    base = {
        "ClaimID": 1, "PolicyID": 5001, "incident_date": "2022-02-12",
        "Claim_Logged_On": "2022-02-13", "Claim_Processed_On": "2022-03-01",
        "Claim_Rejected": "N", "incident_state": "oh", "incident_city": "Dayton",
        "incident_location": "1 Main St", "incident_severity": "Major Damage",
        "incident_type": "Multi-vehicle Collision", "collision_type": "Rear Collision",
        "authorities_contacted": "Police", "bodily_injuries": "1", "injury": "1000",
        "property": "500", "vehicle": "2500", "witnesses": "2",
        "number_of_vehicles_involved": 3, "police_report_available": "YES",
        "property_damage": "YES"}
    return {**base, **changes}


CLAIMS = {
    "Insurance 6/claims_1.json": [
        claim(),
        claim(ClaimID=2, Claim_Processed_On="NULL", Claim_Rejected="Y"),
        claim(ClaimID=3, collision_type="?", police_report_available="?", property_damage="?",
              witnesses="?", Claim_Processed_On=None),
        claim(ClaimID=4, Claim_Processed_On="2022-02-01"),
        claim(ClaimID=None), claim(ClaimID=6, PolicyID=None),
        claim(ClaimID=7, incident_severity="huge"), claim(ClaimID=8, incident_state=" "),
        claim(ClaimID=9, number_of_vehicles_involved=0), claim(ClaimID=10, injury="-5"),
        claim(ClaimID=11, injury="?"), claim(ClaimID=12, incident_date="34:00.0"),
    ],
    "claims_2.json": [
        claim(), claim(ClaimID=13, PolicyID=5008, police_report_available="NO", witnesses="0"),
        claim(ClaimID=14, PolicyID=4711),
        {**claim(ClaimID=15, PolicyID=5002, property_damage="NO"), "note": "late"},
    ],
}


def write(folder: str) -> str:
    files = {**CUSTOMERS, **CARS, **POLICY, **SALES,
             **{n: json.dumps(rows, indent=1) for n, rows in CLAIMS.items()}}
    for name, content in files.items():
        path = Path(folder, name)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
    return folder
