"""Schemas of the stages."""

SKILL = "struct<name:string,confidence:double,sources:array<string>>"
EXPERIENCE = "array<struct<company:string,title:string,start:string,end:string,summary:string>>"
EDUCATION = "array<struct<institution:string,degree:string,field:string,cgpa:string,start_year:int,end_year:int>>"
REJECTION = "array<struct<field:string,raw_value:string,source:string,reason:string>>"
PROVENANCE = "array<struct<field:string,value:string,source:string,method:string>>"

RAW = f"""record_ix long, source string, full_name string, email string, emails array<string>, phone string, phones array<string>,
 location_city string, location_region string, location_country string, linkedin string, github string, portfolio string, headline string,
 years_experience string, skills_text string, skills_list array<string>, experience {EXPERIENCE}, education {EDUCATION}, current_company string, title string, notes string"""
